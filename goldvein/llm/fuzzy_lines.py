"""Fuzzy line deduplication with DataFrame operations only.

Every line of every text is normalised (lower case; runs of characters other
than letters and digits are one space). Two different normal forms are linked
when their SimHashes (64 bits, over the distinct words, so that a frequent
word counts once) differ in at most ``MAX_BITS`` bits and their edit similarity, 1 - edits / longer length, is ``SIMILARITY`` or
more. Of each connected group of lines only the first occurrence stays, by
(doc_id, line number).

* Equal normal forms are one node, named by a 64-bit hash, before anything is
  compared: a line that fills a third of the corpus is one row.
* SimHash counters: the hashes' 64 bits are added up inside the line's row, all 64 at a
  time in binary digits, for the first ``BLOCK * BLOCKS`` distinct words by a fixed tree
  of sums. Lines of more words loop over parts of ``PART`` words, in eight longs
  of eight one-byte counters each, and add those up in wider counters.
* Pigeonhole: the 64 bits are cut into ``MAX_BITS + 2`` blocks; codes within
  ``MAX_BITS`` bits agree on at least two whole blocks, so lines meet on each
  pair of blocks (about 18 bits). SimHashes travel with the rows and are
  compared inside a bucket, so only near pairs leave it.
* First, over ``STAR_KEYS`` of the pairs of blocks, all members of a bucket are
  verified against the smallest (a star, not all pairs): that joins up groups
  of many near copies. Then, over every pair of blocks, members that are not
  connected by now are compared with each other, so no two lines within both
  limits end in different groups. Here a code of a group is one row, however
  many lines of the group have it; near codes are then traced to their lines.

Defined cases: null text has no lines; a line without letters or digits is
never a duplicate and stays; repeated rows (one doc_id, one text) are the same
document and keep or lose the same lines; unlike texts under one doc_id are judged apart; rows with a null doc_id come last and their
texts are not changed by ``without_duplicate_lines``; a very long line costs
time in proportion to length x edits; empty tables give empty
results. Other columns pass through.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, saved

MAX_BITS, SIMILARITY = 5, 0.8  # the bit limit: see the measured recall in the README
STAR_KEYS = 7  # pairs of blocks over which stars are made before all pairs of blocks are searched
BROADCAST_IDS = 500_000  # candidate lines whose ids are sent to the scan that fetches their texts
MASKS_AT_ONCE = 7
BLOCK, BLOCKS = 32, 8  # a line's first distinct words, whose bits are added up in a fixed tree
PART = 127  # words whose bits one-byte counters can count, sign included
_LAST = 2 ** 63 - 1  # stands for a null doc_id in the order of occurrences


def normal(line: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(line), "[^\\p{L}\\p{N}]+", " "))


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, version, line_no, id, norm) of every line with a letter or digit; line_no counts all lines from 0.

    version: a hash of the text, which tells unlike rows of one doc_id apart.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("version"),
                       F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("line_no", "line"))
    norm = normal(F.col("line")).alias("norm")  # not in a filter, which would compute it once more
    return rows.where(F.lower("line").rlike("[\\p{L}\\p{N}]")).select("doc_id", "version", "line_no", norm) \
        .select("doc_id", "version", "line_no", F.xxhash64("norm").alias("id"), "norm")


def _counted(hashes: Column) -> Column:
    """Eight longs of eight one-byte counters each: how many of at most ``PART`` hashes have each bit."""
    zero = F.struct(*[F.lit(0).cast("long").alias(f"s{j}") for j in range(8)])
    low = F.lit(0x0101010101010101)
    return F.aggregate(hashes, zero, lambda sums, h: F.struct(*[
        (sums[f"s{j}"] + F.shiftrightunsigned(h, j).bitwiseAND(low)).alias(f"s{j}") for j in range(8)]))


def _parts(hashes: Column) -> Column:
    """One-byte counters over each part of ``PART`` hashes."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / PART).cast("int")),
                       lambda at: _counted(F.slice(hashes, at * PART + 1, PART)))


def _sum(a: list[str], b: list[str]) -> list[str]:
    """64 sums at once, as SQL: ``a[k]`` and ``b[k]`` hold binary digit k of 64 numbers each, as does the result."""
    if len(a) < len(b):
        a, b = b, a
    planes, carry = [], None
    for k, x in enumerate(a):
        one, both = (f"({x} ^ {b[k]})", f"({x} & {b[k]})") if k < len(b) else (x, None)
        planes.append(f"({one} ^ {carry})" if carry else one)
        carry = " | ".join(c for c in (both, carry and f"({carry} & {one})") if c)
        carry = f"({carry})"
    return [*planes, carry]


def _with_planes(hashed: DataFrame) -> tuple[DataFrame, list[str]]:
    """``hashed`` with columns, one a binary digit: how many of the first ``BLOCK * BLOCKS`` hashes have each of the 64 bits.

    Hashes are added in pairs, the sums in pairs and so on, each round in a projection of its own, so that
    a sum is computed once. A block is taken out by a lambda: Spark generates a method from the projections between
    two of those, and the JVM compiles none above 8000 bytes.
    """
    kept, table, total = hashed.columns, hashed, []
    for block in range(BLOCKS):
        table = table.selectExpr(*kept, *total, f"transform(slice(hashes, {block * BLOCK + 1}, {BLOCK}), h -> h) AS _own")
        sums = [[f"coalesce(get(_own, {i}), 0L)"] for i in range(BLOCK)]
        while len(sums) > 1:
            sums = [_sum(a, b) for a, b in zip(sums[::2], sums[1::2])]
            named = [[f"_p{i}_{k}" for k in range(len(planes))] for i, planes in enumerate(sums)]
            table = table.selectExpr(*kept, *total, *[f"{c} AS {n}" for cs, ns in zip(sums, named) for c, n in zip(cs, ns)])
            sums = named
        more = _sum(total, sums[0]) if total else sums[0]
        total = [f"_t{block}_{k}" for k in range(len(more))]
        table = table.selectExpr(*kept, *[f"{c} AS {n}" for c, n in zip(more, total)])
    return table, total


def simhashes(table: DataFrame) -> DataFrame:
    """``lines`` with sim, the SimHash of every line; each line by itself, without a shuffle."""
    key = ["doc_id", "version", "line_no", "id", "norm"]
    hashed = table.select(*key, F.array_distinct(F.transform(F.split("norm", " "), lambda word: F.xxhash64(word))).alias("hashes"))
    counted, planes = _with_planes(hashed.select("*", F.size("hashes").alias("n")))
    code = "0L"  # where a count is over half of n: the carry of the count and what half of n lacks
    for k, plane in enumerate(planes):
        lacks = f"(~(-CAST(shiftright(n, {k + 1}) & 1 AS BIGINT)))"
        code = f"(({plane} & {lacks}) | ({code} & ({plane} | {lacks})))"
    long = f"n > {BLOCK * BLOCKS}"  # words beyond the blocks: all are counted in a loop
    settled = counted.select(*key, "n", F.expr(code).alias("code"), F.when(F.expr(long), _parts(F.col("hashes"))).alias("parts"))
    ones = [f"aggregate(parts, 0L, (total, sums) -> total + (shiftrightunsigned(sums.s{b % 8}, {b - b % 8}) & 255L))" for b in range(64)]
    majority = " | ".join(f"shiftleft(shiftrightunsigned(n - 2 * {one}, 63), {b})" for b, one in enumerate(ones))  # the sign
    return settled.selectExpr(*key, f"CASE WHEN {long} THEN {majority} ELSE code END AS sim")


def _masks(max_bits: int) -> list[int]:
    """All pairs of the ``max_bits + 2`` blocks of the 64 bits."""
    parts = max_bits + 2
    blocks = [sum(1 << b for b in range(i * 64 // parts, (i + 1) * 64 // parts)) for i in range(parts)]
    masks = [a | b for a, b in combinations(blocks, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def _keyed(sims: DataFrame, masks: list[int]) -> DataFrame:
    """The rows of ``sims`` once per mask, with the ``key`` of their bucket."""
    keys = F.array(*[F.xxhash64(F.lit(m), F.col("sim").bitwiseAND(F.lit(m))) for m in masks])
    return sims.select("*", F.explode(keys).alias("key"))


def _alike(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b, alike): whether the edit similarity of the two normal forms is enough."""
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("norm").alias("_ta")), "a") \
        .join(texts.select(F.col("id").alias("b"), F.col("norm").alias("_tb")), "b") \
        .withColumns({"_wa": F.split("_ta", " "), "_wb": F.split("_tb", " ")})
    longer = F.greatest(F.length("_ta"), F.length("_tb"))
    most = F.floor((1 - F.lit(similarity)) * longer + F.lit(1e-9)).cast("int")
    # edits that are enough in any case: unlike words at one place are rewritten, surplus ones (with their space) added
    enough = F.expr("aggregate(zip_with(split(_ta, ' '), split(_tb, ' '), (x, y) -> "
                    "if(x <=> y, 0, greatest(length(x), length(y)) + if(x is null or y is null, 1, 0))), 0, (sum, n) -> sum + n)")
    # equal words at both ends cost no edits: only what is between them, each word with a space after it, is compared
    for _ in range(2):
        same = F.zip_with("_wa", "_wb", lambda x, y: x.eqNullSafe(y))
        both = both.withColumn("_at", F.greatest(F.array_position(same, False).cast("int"), F.lit(1)))
        both = both.withColumns({w: F.reverse(F.slice(w, F.col("_at"), F.greatest(F.size(w) - F.col("_at") + 1, F.lit(0)))) for w in ("_wa", "_wb")})
    both = both.withColumns({f"_{x}": F.array_join(F.transform(f"_w{x}", lambda word: F.concat(word, F.lit(" "))), "") for x in "ab"})
    # narrow bands first: nearly equal long lines are settled at little cost; no band is tried twice
    within = F.expr("greatest(length(_a), length(_b)) <= _most or levenshtein(_a, _b, least(_most, 16)) >= 0 "
                    "or (_most > 16 and levenshtein(_a, _b, least(_most, 64)) >= 0) "
                    "or (_most > 64 and levenshtein(_a, _b, least(_most, 1024)) >= 0) "
                    "or (_most > 1024 and levenshtein(_a, _b, _most) >= 0)")
    shorter = F.least(F.length("_ta"), F.length("_tb"))
    return both.withColumn("_most", most).select("a", "b", F.when(longer - shorter > F.col("_most"), False)
                                                 .when(enough <= F.col("_most"), True).otherwise(within).alias("alike"))


def _texts(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """(id, norm) of the lines in ``pairs``."""
    ids = saved(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "line-ids")
    few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids  # 8 bytes each; beyond that a shuffled join
    return saved(table.select("id", "norm").join(few, "id", "left_semi").dropDuplicates(["id"]), "line-texts")


def line_links(found: DataFrame, table: DataFrame, max_bits: int = MAX_BITS, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): verified links between distinct lines that connect every pair within both limits.

    ``found``: the (id, sim) of all lines; ``table``: their texts, read for candidates only.
    """
    sims = saved(found.groupBy("id").agg(F.max("sim").alias("sim")), "line-simhash")
    masks = _masks(max_bits)
    bucket = Window.partitionBy("key").orderBy("id")
    stars = _keyed(sims, masks[::max(1, len(masks) // STAR_KEYS)]) \
        .select("id", "sim", F.first("id").over(bucket).alias("low"), F.first("sim").over(bucket).alias("low_sim")) \
        .where((F.col("id") != F.col("low")) & _near("sim", "low_sim", max_bits))
    first = saved(stars.select(*_pair(F.col("id"), F.col("low"))).distinct(), "line-stars")
    # written before it is filtered: a filter would be moved down and compute the trimmed texts again in every place
    near = saved(_alike(first, _texts(first, table), similarity), "line-links").where("alike").select("a", "b")

    # only lines that are not connected by now can still add a link
    rooted = sims.join(components(near, "a", "b").withColumnRenamed("node", "id"), "id", "left") \
        .select("id", "sim", F.coalesce("root", "id").alias("root"))
    rooted = saved(rooted, "line-roots")
    codes = saved(rooted.select("sim", "root").distinct(), "line-codes")
    cross = []
    for at in range(0, len(masks), MASKS_AT_ONCE):  # bounds what is shuffled at a time
        keyed = _keyed(codes, masks[at:at + MASKS_AT_ONCE])
        a, b = keyed.alias("a"), keyed.alias("b")  # one plan twice, so it is shuffled once
        pairs = a.join(b, F.col("a.key") == F.col("b.key")).where((F.col("a.root") < F.col("b.root")) & _near("a.sim", "b.sim", max_bits))
        cross.append(saved(pairs.select(*[F.col(f"{x}.{c}").alias(f"{x}_{c}") for x in "ab" for c in codes.columns]).distinct(), "line-pairs"))
    met = saved(reduce(DataFrame.unionByName, cross).distinct(), "line-met")
    of = lambda x: rooted.select(*[F.col(c).alias(f"{x}_{c}") for c in rooted.columns])
    pairs = met.join(of("a"), ["a_sim", "a_root"]).join(of("b"), ["b_sim", "b_root"])
    rest = saved(pairs.select(*_pair(F.col("a_id"), F.col("b_id"))).distinct().join(first, ["a", "b"], "left_anti"), "line-candidates")
    return near.unionByName(saved(_alike(rest, _texts(rest, table), similarity), "line-links").where("alike").select("a", "b"))


def _judged(docs: DataFrame, id_col: str, text_col: str, max_bits: int = MAX_BITS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, version, line_no, first_doc_id, first_line_no, kept) of every line that has a letter or digit."""
    found = saved(simhashes(lines(docs, id_col, text_col)), "lines")
    links = line_links(found.select("id", "sim"), found.select("id", "norm"), max_bits, similarity)
    groups = components(links, "a", "b").select(F.col("node").alias("id"), F.col("root").alias("group"))
    found = found.select("doc_id", "version", "line_no", "id").join(groups, "id", "left") \
        .select("doc_id", "version", "line_no", F.coalesce("group", "id").alias("group"))
    found = saved(found, "line-groups")
    order = F.coalesce("doc_id", F.lit(_LAST))
    first = F.struct(order.alias("doc"), "line_no", "version")
    firsts = found.groupBy("group").agg(F.min(first).alias("first"))
    out = found.join(firsts, "group")
    return out.select("doc_id", "version", "line_no", F.when(F.col("first.doc") != _LAST, F.col("first.doc")).alias("first_doc_id"),
                      F.col("first.line_no").alias("first_line_no"), (first == F.col("first")).alias("kept"))


def judged_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS,
                 similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, line_no, first_doc_id, first_line_no, kept) of every line that has a letter or digit."""
    return _judged(docs, id_col, text_col, max_bits, similarity).drop("version")


def without_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the duplicate lines taken out of the texts; a text may become empty, no row goes."""
    dropped = _judged(docs, id_col, text_col, **options).where("not kept and doc_id is not null") \
        .groupBy(F.col("doc_id").alias("_of"), F.col("version").alias("_version")).agg(F.collect_set("line_no").alias("_dropped"))
    whole = F.col(text_col).cast("string")
    parts = F.split(whole, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_dropped"))
    text = F.when(F.col("_dropped").isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(left, lambda i: F.element_at(F.col("_parts"), i + 1)), "\n"))
    same = (F.col(id_col).cast("long") == F.col("_of")) & (F.xxhash64(whole) == F.col("_version"))
    out = docs.join(dropped, same, "left").withColumn("_parts", parts)
    return out.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])
