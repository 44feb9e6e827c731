"""Operator 10: n-gram Jaccard self-join with a MinHash LSH forest and exact verification.

Two texts are linked if their sets of five-word shingles have a Jaccard similarity of ``threshold`` or more.

* Texts with equal shingle sets form one class; a class is one row from here on, with its number of documents.
* Every class has ``TREES`` MinHash signatures of ``LONGEST`` values, a path in each tree's trie. Paths that share their shortest prefix with
  another class's are written in the order of their prefixes (``sorted_tries``); all others are in no pair and go no further.
* The forest is climbed level by level. At the longest prefix all classes below a node are candidates. Then prefixes are
  shortened by one value, and only nodes that join several longer prefixes are looked at again: the pairs that are new there are candidates.
* Candidates' shingle sets are compared exactly. Each link's similarity tells how likely the prefixes so far were to find it, so the links
  found estimate how many were not (``estimated_recall``; one more link at the threshold itself is always assumed). Shortening goes on until the
  estimate reaches ``recall``, at the latest until a pair at the threshold is found with that probability.
* A node of any size is cut into blocks of about ``BLOCK`` classes and each pair of blocks
  is a group of its own, so a hot node is spread over many tasks and no group grows with the data. A pair counts at the
  longest prefix and in the first tree in which it meets, and nowhere else. Pairs are never rows: a group's pairs live in
  one matrix, and only the classes that have some pair in it go on. Link counts are exact, so each block meets each other one, but as one
  packed row: a node of n classes costs n rows in the joins and (n / BLOCK) ** 2 rows of blocks.
* A group returns, for each class, how many documents it
  is linked to there, and a star of links for each cluster within the group, from which the components follow.

The result has one row per document row: its class -- the smallest doc_id of the documents that links connect -- and its number of links.

Edge cases: a text of one to four words has one shingle, all its words; a NULL, empty or blank text has no shingle,
no link and a class of its own; equal texts are linked, also if they are repeated rows; ids that are NULL name no class
unless no other id is there (then the class is NULL); an empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bitmap
from tidemark.llm.common import give_back_memory, materialize, new_name, release_shuffles, row_key, ship
from tidemark.llm.components import components
from tidemark.llm.words import forget_words, mix, shingles

THRESHOLD = 0.8
TREES = 16
LONGEST = 6
RECALL = 0.9999
BLOCK = 256
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def found_by(similarity, depth: int, trees: int = TREES):
    """Probability that sets of this similarity share a prefix of ``depth`` values in some tree."""
    return 1 - (1 - similarity ** depth) ** trees


def prefix_lengths(threshold: float = THRESHOLD, recall: float = RECALL) -> list[int]:
    """Prefix lengths from the longest to the one that finds pairs at the threshold with probability ``recall``."""
    shortest = LONGEST
    while shortest > 1 and found_by(threshold, shortest) < recall:
        shortest -= 1
    return list(range(LONGEST, shortest - 1, -1))


def estimated_recall(found: int, unseen: float, threshold: float, depth: int) -> float:
    """Share of all links that prefixes down to ``depth`` found.

    ``unseen``: the sum over the links found of 1 / (probability of finding it) - 1. A link at the threshold is assumed
    besides, so that few links, or none, are no proof.
    """
    return (found + 1) / (found + unseen + 1 / found_by(threshold, depth))


def hash_functions() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of one hash function for each trie level of each tree."""
    n = mix(np.arange(1, 2 * TREES * LONGEST + 1, dtype=np.uint64) * _GOLD)
    return n[::2] | np.uint64(1), n[1::2]


def signature(grams: np.ndarray, lengths: list[int], functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The hashes of the MinHash prefixes, a matrix of lengths x trees."""
    a, b = (x[:, None] for x in functions)
    least = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(grams), 2048):
        h = a * grams[None, at:at + 2048]
        h += b
        least = np.minimum(least, h.min(axis=1))
    least = mix(least).reshape(TREES, LONGEST)
    prefix, of_length = np.arange(TREES, dtype=np.uint64), {}
    for k in range(LONGEST):
        prefix = (prefix ^ least[:, k]) * _GOLD
        prefix ^= prefix >> np.uint64(29)
        of_length[k + 1] = prefix
    return np.stack([of_length[d] for d in lengths])


def meeting_pairs(tree: int, here: np.ndarray, longer: np.ndarray | None, sizes: np.ndarray, left: np.ndarray, right: np.ndarray,
                  same: bool, threshold: float) -> np.ndarray:
    """Boolean matrix left x right: does this pair of a group count in this tree, at this length (prefixes ``here``)?

    Not if it met by a longer prefix (``longer``: those longer by one, None at the longest), nor in an earlier tree, nor if the sizes alone
    keep it below the threshold. ``same``: left and right are one block.
    """
    a, b = sizes[left][:, None], sizes[right][None, :]
    ok = np.minimum(a, b) >= threshold * np.maximum(a, b)
    if same:
        ok &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
    for before in [here[:, :tree]] + ([] if longer is None else [longer]):
        for t in range(before.shape[1]):
            ok &= before[left, t][:, None] != before[right, t][None, :]
    return ok


def common_shingles(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets, a matrix left x right."""
    if len(left) == len(right) == 1:
        return np.array([[len(np.intersect1d(sets[left[0]], sets[right[0]], assume_unique=True))]])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, gram, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[gram] > 1  # a shingle of one set is in no intersection
    owner, gram = owner[keep], np.unique(gram[keep], return_inverse=True)[1]
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for first in range(0, int(gram[-1]) + 1 if len(gram) else 0, 4096):
        a, b = np.searchsorted(gram, [first, first + 4096])
        m = np.zeros((len(sets), 4096), dtype=np.float32)
        m[owner[a:b], gram[a:b] - first] = 1
        out += m[left] @ m[right].T
    return out.astype(np.int64)


def _sides(blocks: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, bool]:
    return np.flatnonzero(blocks == lo), np.flatnonzero(blocks == hi), lo == hi


def _clusters(n: int, pairs: np.ndarray) -> list[int]:
    parent = list(range(n))
    for a, b in pairs.tolist():
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        parent[max(a, b)] = min(a, b)
    for a in range(n):
        parent[a] = parent[parent[a]]  # parents come before their children
    return parent


def prefix_column(length: int) -> str:
    """Name of the array of a class's prefixes of this length, one a tree."""
    return f"p{length}"


def document_sets(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, _id, _th, set_id, n and the prefixes of each length) of every row of ``docs``."""
    functions, names = hash_functions(), [prefix_column(d) for d in lengths]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, prefixes = [], [], []
            for text in batch.column(3).to_pylist():
                grams = shingles(text)
                ids.append(xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                sizes.append(len(grams))
                prefixes.append(signature(grams, lengths, functions).view(np.int64) if len(grams) else [None] * len(lengths))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(ids, pa.binary()), pa.array(sizes, pa.int32()),
                 *(pa.array([p[k] for p in prefixes], pa.list_(pa.int64())) for k in range(len(lengths)))],
                names=["doc_id", "_id", "_th", "set_id", "n", *names])
        forget_words()
        give_back_memory()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(), "text").mapInArrow(
        of, "doc_id long, _id long, _th long, set_id binary, n int, " + ", ".join(f"{c} array<bigint>" for c in names))


def sorted_tries(classes: DataFrame, lengths: list[int]) -> DataFrame:
    """(tree, set_id and its prefix of each length) of the classes whose shortest prefix another class has too, sorted by their prefixes."""
    names = [prefix_column(d) for d in reversed(lengths)]
    paths = (classes.select("set_id", F.posexplode(F.arrays_zip(*names)).alias("tree", "path"))
             .select("set_id", "tree", *(F.col("path")[c].alias(c) for c in names)))
    shared = paths.groupBy("tree", names[0]).agg(F.count("*").alias("size")).where("size > 1").drop("size")
    return paths.join(shared, ["tree", names[0]]).select("set_id", "tree", *names).sortWithinPartitions("tree", *names)


def candidate_groups(classes: DataFrame, tries: DataFrame, length: int, longer: int | None, threshold: float, block: int) -> DataFrame:
    """(tree, node, lo, hi, block, set_ids): the classes of a block that have a pair to verify in that pair of blocks of a trie node.

    A class joins its values once a node; blocks travel to their pairs packed, as a row each.
    ``length``: of the node's prefix; ``longer``: the length before it, by which no pair counts again (None: there is none).
    """
    here, child = prefix_column(length), F.lit(None).cast("long") if longer is None else F.col(prefix_column(longer))
    paths = tries.select("set_id", "tree", F.col(here).alias("node"), child.alias("child"))
    # A node with a single longer prefix below it has no new pair.
    several = F.lit(True) if longer is None else F.col("first") != F.col("last")
    crowded = paths.groupBy("tree", "node").agg(F.count("*").alias("size"), F.min("child").alias("first"), F.max("child").alias("last"))
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    members = (paths.join(crowded.where(F.col("size") > 1).where(several).select("tree", "node", "size"), ["tree", "node"])
               .withColumn("blocks", blocks).select("tree", "node", "blocks", own.alias("block"), "set_id", "child"))
    member = F.struct("set_id", "block", "n", *_prefixes(length, longer))
    packed = (members.join(classes, "set_id").groupBy("tree", "node", "blocks", "block")
              .agg(F.collect_list(member).alias("members"), F.min("child").alias("first"), F.max("child").alias("last"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    groups = (packed.groupBy("tree", "node", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
              .agg(F.collect_list("members").alias("members"), F.min("first").alias("first"), F.max("last").alias("last"))
              .where((F.size("members") > 1) | (F.size(F.col("members")[0]) > 1)).where(several).drop("first", "last"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tree, node, lo, hi, members in _groups(batch):
                left, right, same = _sides(np.array([m["block"] for m in members]), lo, hi)
                pairs = meeting_pairs(tree, *_matrices(members, longer), np.array([m["n"] for m in members]), left, right, same, threshold)
                some = {*left[pairs.any(axis=1)].tolist(), *right[pairs.any(axis=0)].tolist()}
                for b in {lo, hi} if some else ():
                    rows.append((tree, node, lo, hi, b, [members[i]["set_id"] for i in sorted(some) if members[i]["block"] == b]))
            types = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 6, types)],
                                             names=["tree", "node", "lo", "hi", "block", "set_ids"])

    return groups.mapInArrow(meet, "tree int, node long, lo int, hi int, block int, set_ids array<binary>")


def block_classes(groups: DataFrame) -> DataFrame:
    """(tree, node, block, set_id) of the classes that have a pair to verify in some group of their block."""
    return (groups.groupBy("tree", "node", "block").agg(F.array_distinct(F.flatten(F.collect_list("set_ids"))).alias("set_ids"))
            .select("tree", "node", "block", F.explode("set_ids").alias("set_id")))


def _groups(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch; the members (last column, a list a block) of one group at a time become Python objects, in one list."""
    *keys, members = batch.columns
    for i, key in enumerate(zip(*(c.to_pylist() for c in keys))):
        yield *key, [m for packed in members[i] for m in packed.as_py()]


def _prefixes(length: int, longer: int | None) -> list:
    return [F.col(prefix_column(length)).alias("here"), *([] if longer is None else [F.col(prefix_column(longer)).alias("longer")])]


def _matrices(members: list[dict], longer: int | None) -> tuple[np.ndarray, np.ndarray | None]:
    return np.array([m["here"] for m in members]), None if longer is None else np.array([m["longer"] for m in members])


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set_id, grams) of the classes in ``wanted`` (set_id, _id, _th: a document of each).

    The documents first pass a bitmap of fixed size, then join exactly: texts are not shuffled.
    """
    there = docs.sparkSession.sparkContext.broadcast(bitmap.build(wanted, "_th"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maybe = np.flatnonzero(bitmap.contains(there.value, np.asarray(batch.column(1)).view(np.uint64)))
            batch = batch.take(pa.array(maybe))
            grams = [shingles(t).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(grams, pa.binary())], names=["_id", "_th", "grams"])
        forget_words()
        give_back_memory()

    found = docs.select(*row_key(), "text").mapInArrow(of, "_id long, _th long, grams binary")
    return found.join(wanted, ["_id", "_th"]).groupBy("set_id").agg(F.max("grams").alias("grams"))  # one row of repeated ones


def verified(groups: DataFrame, classes: DataFrame, sets: DataFrame, length: int, longer: int | None, lengths: list[int], threshold: float) -> DataFrame:
    """(set_id, root, linked, found, unseen): in each group, the least class of each class's cluster there and the documents it is linked to.

    ``found`` counts the class's links to later classes of the group, ``unseen`` sums 1 / (probability of finding it) - 1 over them
    for each of ``lengths``.
    """
    member = F.struct("set_id", "block", "n", "documents", "grams", *_prefixes(length, longer))
    blocks = (block_classes(groups).join(classes.join(sets, "set_id"), "set_id")
              .groupBy("tree", "node", "block").agg(F.collect_list(member).alias("members")))
    here = F.filter("members", lambda m: F.array_contains(F.col("set_ids"), m["set_id"]))
    packed = (groups.join(blocks, ["tree", "node", "block"]).select("tree", "node", "lo", "hi", here.alias("members"))
              .groupBy("tree", "node", "lo", "hi").agg(F.collect_list("members").alias("members")))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tree, _, lo, hi, members in _groups(batch):
                members.sort(key=lambda m: m["set_id"])
                sizes, weight = (np.array([m[k] for m in members]) for k in ("n", "documents"))
                left, right, same = _sides(np.array([m["block"] for m in members]), lo, hi)
                pairs = meeting_pairs(tree, *_matrices(members, longer), sizes, left, right, same, threshold)
                common = common_shingles([np.frombuffer(m["grams"], dtype=np.uint64) for m in members], left, right)
                similarity = common / (sizes[left][:, None] + sizes[right][None, :] - common)
                linked = pairs & (similarity >= threshold)
                count, found, unseen = np.zeros(len(members), np.int64), np.zeros(len(members), np.int64), np.zeros((len(members), len(lengths)))
                count[left] += linked @ weight[right]
                count[right] += linked.T @ weight[left]
                a, b = np.nonzero(linked)
                found[left] += linked.sum(axis=1)
                for k, d in enumerate(lengths):
                    unseen[:, k] = np.bincount(left[a], 1 / found_by(similarity[a, b], d) - 1, len(members))
                root = _clusters(len(members), np.stack([left[a], right[b]], axis=1))
                rows += [(members[i]["set_id"], members[root[i]]["set_id"], c, found[i], unseen[i]) for i, c in enumerate(count.tolist()) if c]
            types = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 5, types)],
                                             names=["set_id", "root", "linked", "found", "unseen"])
        give_back_memory()

    return packed.mapInArrow(verify, "set_id binary, root binary, linked long, found long, unseen array<double>")


def climb(docs: DataFrame, classes: DataFrame, lengths: list[int], threshold: float, recall: float, block: int) -> DataFrame:
    """(set_id, root, linked) of all links that the forest finds, from the longest prefixes to those that reach ``recall``."""
    tries = materialize(sorted_tries(classes, lengths), "sorted-tries")
    levels, longer = [], None
    for k, length in enumerate(lengths):
        groups = materialize(candidate_groups(classes, tries, length, longer, threshold, block), "candidate-groups")
        wanted = block_classes(groups).select("set_id").distinct().join(classes, "set_id").select("set_id", "first._id", "first._th")
        links = materialize(verified(groups, classes, shingle_sets(docs, wanted), length, longer, lengths, threshold), "links")
        levels.append(links)
        found, unseen = reduce(DataFrame.unionAll, levels).agg(
            F.coalesce(F.sum("found"), F.lit(0)), F.coalesce(F.sum(F.col("unseen")[k]), F.lit(0.0))).first()
        release_shuffles(docs.sparkSession)
        if estimated_recall(found, unseen, threshold, length) >= recall:
            break
        longer = length
    return reduce(DataFrame.unionAll, levels).select("set_id", "root", "linked")


def link_documents(docs: DataFrame, *, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(doc_id, class_id, n_links, _id, _th, _class) for every row of ``docs``.

    ``_class`` names the row's group of linked documents: unlike class_id it is not shared by groups that have an id in common, or none.
    """
    ship(docs.sparkSession)
    lengths = prefix_lengths(threshold, recall)
    rows = materialize(document_sets(docs, lengths), "shingle-signatures")
    # Copies meet here, in partial sums; "first" names a document of the class.
    classes = materialize(rows.where("set_id IS NOT NULL").groupBy("set_id", "n", *(prefix_column(d) for d in lengths)).agg(
        F.count("*").alias("documents"), F.min("doc_id").alias("least_id"), F.min(F.struct("_id", "_th")).alias("first")), "shingle-classes")
    links = climb(docs, classes, lengths, threshold, recall, block)

    cluster = components(links.select(F.col("set_id").alias("u"), F.col("root").alias("v")))
    grouped = (links.groupBy("set_id").agg(F.sum("linked").alias("linked"))
               .join(cluster.withColumnRenamed("node", "set_id"), "set_id", "right"))
    least = (grouped.join(classes, "set_id").groupBy("component").agg(F.min("least_id").alias("class_id")))
    others = grouped.join(least, "component").select("set_id", "component", "class_id", "linked")
    # Written, so that the last join is a plain one between two tables and the copies of a hot class can be split.
    per_class = materialize(classes.join(others, "set_id", "left").select(
        "set_id", F.coalesce("component", "set_id").alias("_class"),
        # A component's class_id is NULL only if all its ids are, and then so is the least id of each of its classes.
        F.coalesce("class_id", "least_id").alias("class_id"),
        (F.coalesce("linked", F.lit(0)) + F.col("documents") - 1).alias("n_links")), "linked-classes")
    return rows.join(per_class, "set_id", "left").select(
        "doc_id", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "_id", "_th", "_class")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` for each class of linked documents, with the same columns.

    The one with the least id stays (a missing id counts as the least; of rows with that id, the one with the least text hash and, of repeated rows, one). Groups that
    share an id but no link keep a row each.
    Documents without words are all kept.
    """
    linked = link_documents(docs, **options)
    # The row to keep, in two short columns; partial minima, so a class of any size is no hot spot.
    key, row = [new_name("_tm_id", docs), new_name("_tm_th", docs)], new_name("_tm_row", docs)
    rows = linked.select("_id", "_th", "_class", "n_links")
    best = rows.where("n_links > 0").groupBy("_class").agg(F.min(F.struct("_id", "_th")).alias("best")).select("best._id", "best._th")
    leave = rows.where("n_links > 0").select("_id", "_th").distinct().join(best, ["_id", "_th"], "left_anti").toDF(*key)
    keyed = docs.withColumns(dict(zip(key, row_key())))
    # Repeated rows of the one that stays share its key: one of them is enough. Rows without words are kept each.
    blank = ~F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))
    each = F.when(blank, F.monotonically_increasing_id()).otherwise(F.lit(-1))
    kept = keyed.withColumn(row, each).join(leave, key, "left_anti")
    return kept.dropDuplicates([*key, row]).select(*docs.columns)
