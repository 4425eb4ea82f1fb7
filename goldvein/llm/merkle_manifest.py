"""Merkle manifest of a dataset, by a nested-struct rollup.

Each row is a leaf; the leaves of a language, ascending by id, are hashed in
runs of ``2`` until one node, the subroot, remains, and the subroots likewise
give the root.

A node's rank is written in digits of ``BITS`` binary levels. Within a block of
``DIGITS`` digits the digit columns are grouped away one after the other, the
lowest first: the children of a group, sorted by their digit, nest in one
struct with the hashes of the binary levels above them. All groupings of a
block share one partitioning, so rows move once a round; a round makes one
node of every block, and the next round works on those, until each tree is one
node. A block has at most ``1 << BITS * DIGITS`` nodes, whatever the data.

Proofs come from the top down: a transform over the nested structs puts down
each child's siblings, level by level, and an explode gives the children their
rows. Between rounds a block and the siblings above it meet as two rows of one
group; nothing is joined for a proof.

Defined cases: null in any column is hashed as ``-``; a null language is a
language and comes first; a null id comes last; rows of one id are leaves of
their own, in the order of their hashes; repeated rows are leaves with equal hashes
next to each other, and each gets one of their places; empty and very long
texts are hashed whole; an empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

BITS, DIGITS = 4, 2  # binary levels a digit, digits a block: blocks of 256 nodes


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def hashed_fields(columns: list[Column]) -> Column:
    """H of the values, each ``-`` if null, else its bytes in UTF-8, a colon and the value."""
    texts = [c.cast("string") for c in columns]
    return digest(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]))


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with pos, from 0, and size within each value of ``tree``; stored.

    Rows are range-partitioned over all trees together, so a tree of any size
    is spread; equal rows are spread as well. The windows run inside one
    partition's rows and over one row a (tree, partition).
    """
    key = [F.col(tree), *[F.col(c).asc_nulls_last() for c in order], F.col("_any")]
    mixed = rows.withColumn("_any", F.monotonically_increasing_id())
    sliced = saved(mixed.repartitionByRange(*key).withColumn("_slice", F.spark_partition_id()), "merkle-slices")
    counts = sliced.groupBy(tree, "_slice").agg(F.count("*").alias("_n"))
    per = Window.partitionBy(tree)
    before = F.sum("_n").over(per.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(tree, "_slice", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(per).alias("size"))
    inside = F.row_number().over(Window.partitionBy(tree, "_slice").orderBy(*key[1:]))
    out = sliced.withColumn("_at", inside).join(counts, [tree, "_slice"]).withColumn("pos", F.col("_before") + F.col("_at") - 1)
    return out.drop("_slice", "_any", "_before", "_at")


def _pairs(nodes: Column) -> Column:
    """The level above: H of every two nodes, the last alone if their number is odd."""
    last = F.floor((F.size(nodes) - 1) / 2).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: digest(F.concat(
        F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit("")))))


def roll(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """(tree, size, block, h, kids, levels) of every block of the nodes (tree, size, pos, h, payload), stored.

    size counts the nodes of the tree; h is the block's node; kids are nested
    structs (digit, h, kids, levels) down to (digit, h, payload); levels the
    hashes of the binary levels that the last digit's siblings lie on.
    """
    digits = [f"_d{k}" for k in range(DIGITS)]
    place = {d: F.shiftright("pos", BITS * k).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int") for k, d in enumerate(digits)}
    depth = F.when(F.col("size") > 1, F.length(F.bin(F.col("size") - 1))).otherwise(0)
    rows = nodes.withColumns(place | {"block": F.shiftright("pos", BITS * DIGITS)}).repartition("tree", "block")
    rows = rows.select("tree", "size", "block", *digits, F.struct(F.col(digits[0]).alias("digit"), "h", *payload).alias("kid"))
    for k, digit in enumerate(digits):
        rows = rows.groupBy("tree", "size", "block", *digits[k + 1:]).agg(F.sort_array(F.collect_list("kid")).alias("kids"))
        rows = rows.withColumn("_l0", F.transform("kids", lambda kid: kid["h"]))
        for j in range(BITS):
            rows = rows.withColumn(f"_l{j + 1}", _pairs(F.col(f"_l{j}")))
        rows = rows.withColumn("_steps", F.greatest(F.lit(0), F.least(F.lit(BITS), depth - BITS * k)))  # a tree ends where one node is left
        levels = F.array(*[F.col(f"_l{j}") for j in range(BITS + 1)])
        rows = rows.select("tree", "size", "block", *digits[k + 1:], F.get(F.get(levels, F.col("_steps")), F.lit(0)).alias("h"),
                           "kids", F.slice(levels, F.lit(1), F.col("_steps")).alias("levels"))
        if k + 1 < DIGITS:
            rows = rows.select("tree", "size", "block", *digits[k + 1:],
                               F.struct(F.col(digits[k + 1]).alias("digit"), "h", "kids", "levels").alias("kid"))
    return saved(rows, "merkle-blocks")


def rolls(nodes: DataFrame, payload: list[str]) -> list[DataFrame]:
    """Rounds of ``roll`` until every tree is one node; the first is that of ``nodes``."""
    most = nodes.agg(F.max("size")).first()[0]
    out = []
    while most:
        out.append(roll(nodes, payload))
        most = -(-most >> BITS * DIGITS) if most > 1 else 1
        if most == 1:
            break
        nodes = out[-1].select("tree", F.ceil(F.col("size") / (1 << BITS * DIGITS)).cast("long").alias("size"), F.col("block").alias("pos"), "h")
        nodes, payload = nodes.withColumn("child", F.col("pos")), ["child"]
    return out


def _siblings(levels: Column, digit: Column) -> Column:
    """Per binary level the other node of the run, on its side; both null where there is none."""
    def at(level: Column, j: Column) -> Column:
        i = F.call_function("shiftright", digit, j)
        odd = i.bitwiseAND(F.lit(1)) == 1
        return F.struct(F.when(odd, F.get(level, i - 1)).alias("left"), F.when(~odd, F.get(level, i + 1)).alias("right"))
    return F.transform(levels, at)


def _children(blocks: DataFrame, payload: list[str]) -> DataFrame:
    """(tree, h, payload, path, subroot, root) of all nodes inside blocks that carry the path above them."""
    def below(kids: Column, levels: Column, above: Column, digits: int) -> Column:
        if digits == 1:
            return F.transform(kids, lambda kid: F.struct(kid["h"].alias("h"), *[kid[p].alias(p) for p in payload],
                                                          F.concat(_siblings(levels, kid["digit"]), above).alias("path")))
        return F.flatten(F.transform(kids, lambda kid: below(
            kid["kids"], kid["levels"], F.concat(_siblings(levels, kid["digit"]), above), digits - 1)))

    nodes = blocks.select("tree", "subroot", "root", F.explode(below(F.col("kids"), F.col("levels"), F.col("path"), DIGITS)).alias("node"))
    return nodes.select("tree", "node.*", "subroot", "root")


def _descend(rounds: list[DataFrame], tops: DataFrame, payload: list[str]) -> DataFrame:
    """The nodes of the first round, with their paths; ``tops``: (tree, block, path, subroot, root) of the last round's blocks."""
    for k in range(len(rounds) - 1, -1, -1):
        blocks = rounds[k].select("tree", "block", "kids", "levels")
        both = blocks.unionByName(tops, allowMissingColumns=True).groupBy("tree", "block").agg(
            *[F.first(c, ignorenulls=True).alias(c) for c in ("kids", "levels", "path", "subroot", "root")])
        nodes = _children(both, payload if k == 0 else ["child"])
        tops = nodes.select("tree", F.col("child").alias("block"), "path", "subroot", "root") if k else nodes
    return tops


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda h, s: digest(F.concat(F.coalesce(s["left"], F.lit("")), h, F.coalesce(s["right"], F.lit("")))))


def manifest(leaves: DataFrame, payload: list[str], order: list[str]) -> DataFrame:
    """(h, payload, path, subroot, root) of the leaves (tree, h, payload): trees ascend bytewise.

    path: per level from the leaf to the root the sibling on the left or on the
    right as ``struct(left, right)``, both null where a node was alone.
    """
    rounds = rolls(numbered(leaves, "tree", order), payload)
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    if not rounds:
        none = F.lit(None).cast("string")
        return leaves.select("h", *payload, no_path.alias("path"), none.alias("subroot"), none.alias("root")).limit(0)
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "h")
    upper = rolls(numbered(subroots, "tree", ["of"]), ["of"])
    top = upper[-1].select("tree", "block", no_path.alias("path"), F.lit("").alias("subroot"), F.col("h").alias("root"))
    trees = _descend(upper, top, ["of"]).select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("block"), "path",
                                                F.col("h").alias("subroot"), "root")
    return _descend(rounds, trees, payload).drop("tree")


def tampered(id_col: Column) -> Column:
    """Whether a row is tampered with: by the CRC-32 of its id; never for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 7 == 0, F.lit(False))


def document_manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang",
                      chars_col: str = "n_chars", text_col: str = "text") -> DataFrame:
    """(doc_id, leaf, path, subroot, root, changed): one row a document; changed is its leaf once 1 is added to n_chars,
    where it is tampered with, else null."""
    names = {"_id": id_col, "_source": source_col, "_lang": lang_col, "_chars": chars_col, "_text": text_col}
    rows = docs.select(*[F.col(c).alias(n) for n, c in names.items()])
    fields = lambda chars: [F.col("_id").cast("long"), F.col("_source"), F.col("_lang"), chars, F.col("_text")]
    chars = F.col("_chars").cast("decimal(20,0)")
    more = F.when(tampered(F.col("_id").cast("long")), hashed_fields(fields(chars + 1)))
    tree = F.when(F.col("_lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("_lang").cast("string")))
    leaves = rows.select(tree.alias("tree"), hashed_fields(fields(chars)).alias("h"), F.col("_id").cast("long").alias("doc_id"),
                         more.alias("changed"))
    return manifest(leaves, ["doc_id", "changed"], ["doc_id", "h"]).withColumnRenamed("h", "leaf")


def verified(found: DataFrame) -> DataFrame:
    """The digest columns of ``document_manifest``: proofs as one hash, and the roots that tampered leaves fold to."""
    sides = F.transform("path", lambda s: F.concat(F.coalesce(s["left"], F.lit("")), F.coalesce(s["right"], F.lit(""))))
    out = found.select("doc_id", "leaf", "subroot", "root", digest(F.array_join(sides, "")).alias("proof_sha256"),
                       folded(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
