"""Merkle manifest of a dataset: digests of all rows, trees over them, and a proof for each row.

A *leaf* is a row's digest. The leaves of a group (one per language, say), in the order of their ids, are a tree's
lowest nodes; while it has several nodes at a level, every ``FANOUT`` in a row become one of the next level, whose
digest is that of theirs. The groups' top nodes, in the order of the groups, are the leaves of one more tree.

Method: nested-interval labels. A node carries the interval ``[lo, hi)`` of the leaf ranks that it covers, so ``a`` is
an ancestor of ``b`` when b's interval lies in a's, without any pointers.

- Building: ranks come from range partitions (a group that holds most rows is spread over many tasks); the
  nodes of a level are grouped by ``floor(lo / FANOUT^level)``. A group has at most ``FANOUT`` rows whatever the
  data. Every level is written once to the shared folder and has an eighth of the rows of the one below.
- Ancestors: level by level from the top, nodes are joined with those of the next level on that bucket and on
  ``parent.lo <= lo and hi <= parent.hi``; a parent brings along the path from it to the root, so a leaf
  takes part in one join, not in one per level. Each level's paths are written to the shared folder as well.
- Siblings: the nodes that cover the difference of the parent's interval and the node's own, which is what
  lies before (``[parent.lo, lo)``) and behind (``[hi, parent.hi)``).

Only digests and ids are shuffled, never texts. To the driver come the number of levels and the partitions' row counts.

Defined cases: a null in any field counts as ``-`` and differs from an empty value; rows with a null group are the first
group; null ids come first; texts of any length are read whole; rows that tie in group and id are ordered by their digest, so
equal rows are leaves of their own with equal digests; an empty table has no rows and no root; other columns
are neither read nor returned, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asrprep.llm.exprs import let
from asrprep.operators.joins import checked_broadcast
from asrprep.operators.ordering import with_global_index
from asrprep.session import scratch_path

FANOUT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left: string, right: string>>"
KIDS = "array<struct<lo: bigint, hi: bigint, digest: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it goes into a leaf: ``-`` for null, else its UTF-8 byte count, a colon and the value."""
    return let(value.cast("string"), lambda v: F.when(v.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)))


def leaf_of(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _levels(leaves: DataFrame, most: int, name: str) -> list[DataFrame]:
    """The levels over ``leaves`` (tree, n, lo, hi, digest): tables of (tree, n, lo, hi, digest, kids), from the lowest up. ``n``
    is the number of the tree's leaves, ``most`` the largest of these."""
    below, out, span = leaves, [], 1
    while span < most:
        below = _saved(below.where(F.col("n") > span)
                       .groupBy("tree", F.floor(F.col("lo") / (span * FANOUT)).alias("bucket"))
                       .agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"))
                       .select("tree", "n", F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"),
                               F.sha2(F.concat_ws("", F.transform("kids", lambda k: k["digest"])), 256).alias("digest"), "kids"),
                       f"{name}-{len(out) + 1}")
        out.append(below)
        span *= FANOUT
    return out


def _attach(nodes: DataFrame, parents: DataFrame, span: int) -> DataFrame:
    """``nodes`` with the path of the parent of each, its siblings before it; ``span`` is the number of leaves under a parent.
    ``parents`` brings its own path and any columns that its whole tree shares."""
    mine = nodes.withColumn("bucket", F.floor(F.col("lo") / span))
    theirs = parents.select("tree", F.floor(F.col("lo") / span).alias("bucket"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"),
                            F.col("kids").alias("p_kids"), *[c for c in parents.columns if c not in ("tree", "n", "lo", "hi", "digest", "kids")])
    within = (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))

    def cover(lo: Column, hi: Column) -> Column:
        return F.concat_ws("", F.transform(F.filter("p_kids", lambda k: (k["lo"] >= lo) & (k["hi"] <= hi)), lambda k: k["digest"]))

    step = F.struct(cover(F.col("p_lo"), F.col("lo")).alias("left"), cover(F.col("hi"), F.col("p_hi")).alias("right"))
    return (mine.join(theirs, ["tree", "bucket"]).where(within)
            .withColumn("path", F.concat(F.array(step), "path")).drop("bucket", "p_lo", "p_hi", "p_kids"))


def _with_paths(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """``leaves`` with the path of each to the root. ``tops`` holds the top node of every tree, its ``level`` (0: a lone leaf),
    path and what the tree's leaves are to get besides. Each level's paths are written before the next one's."""
    above, shared = None, [c for c in tops.columns if c not in ("n", "lo", "hi", "digest", "kids", "level")]
    for k in range(len(levels), 0, -1):
        here, span = tops.where(F.col("level") == k).drop("level"), FANOUT ** k
        if above is not None:
            here = here.unionByName(_attach(levels[k - 1].where(F.col("n") > span), above, span * FANOUT))
        above = _saved(here, f"{name}-paths-{k}")
    lone = leaves.where("n = 1").join(tops.where("level = 0").select(*shared), "tree")
    return lone if above is None else lone.unionByName(_attach(leaves.where("n > 1"), above, FANOUT))


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def siblings(path: Column) -> Column:
    """All siblings' digests, level by level from the leaf to the root, left to right."""
    return F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"])))


def manifest(leaves: DataFrame) -> DataFrame:
    """For ``leaves`` (grp string, doc_id, leaf, and any more columns) a row each with subroot, root and path (array of
    left, right: the digests of the siblings before and behind, from the leaf's level to the root's)."""
    key = F.coalesce(F.concat(F.lit("1"), F.col("grp")), F.lit("0"))  # null first, then by bytes
    ranked = with_global_index(leaves.withColumn("_key", key), ["_key", "doc_id", "leaf"], "_at")
    groups = with_global_index(ranked.groupBy("_key").agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("n")), ["_key"], "tree")
    size = groups.agg(F.max("n"), F.count(F.lit(1))).collect()[0]
    rows = _saved(ranked.join(checked_broadcast(groups), "_key")
                  .withColumn("lo", F.col("_at") - F.col("_from")).withColumn("hi", F.col("lo") + 1)
                  .withColumn("digest", F.col("leaf")).drop("_key", "_at", "_from", "grp"), "merkle-leaves")
    levels = _levels(rows.select("tree", "n", "lo", "hi", "digest"), size[0] or 0, "merkle")

    # the tree over the groups' top nodes; ``node`` is such a node in its own tree
    tops = rows.where("n = 1").select("tree", "n", "lo", "hi", "digest", F.lit(None).cast(KIDS).alias("kids"), F.lit(0).alias("level"))
    for k, nodes in enumerate(levels, 1):
        tops = tops.unionByName(nodes.where(f"n <= {FANOUT ** k} and n > {FANOUT ** (k - 1)}").withColumn("level", F.lit(k)))
    subroots = _saved(tops.select(F.lit(0).cast("long").alias("tree"), F.lit(size[1]).cast("long").alias("n"), F.col("tree").alias("lo"),
                                  (F.col("tree") + 1).alias("hi"), "digest", F.struct(*tops.columns).alias("node")), "merkle-subroots")
    upper = _levels(subroots.drop("node"), size[1], "merkle-top")
    root = (upper[-1] if upper else subroots.drop("node").withColumn("kids", F.lit(None).cast(KIDS))).select(
        "*", F.lit(len(upper)).alias("level"), F.col("digest").alias("root"), F.array().cast(PATH).alias("path"))
    over = _saved(_with_paths(subroots, upper, root, "merkle-top").select("node.*", F.col("digest").alias("subroot"), "root", "path"),
                  "merkle-tops")
    return _with_paths(rows, levels, over, "merkle").drop("tree", "n", "lo", "hi", "digest")


def document_leaves(docs: DataFrame) -> DataFrame:
    """The leaves of ``documents``, by language, and ``changed``: the leaf of a tampered row, of which the text has A-Z in
    lower case (where 3 divides the crc32 of the id as text), else the leaf."""
    def leaf(text: Column) -> Column:
        return leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return docs.select(F.col("lang").alias("grp"), "doc_id", leaf(F.col("text")).alias("leaf"),
                       F.when(tampered, leaf(F.translate("text", UPPER, LOWER))).alias("changed"))


def proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, path, and changed, folded_root, verified: the check of every row, tampered or not, against
    its path."""
    found = manifest(document_leaves(docs)).withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def _tree_sql(name: str, leaves: str, levels: int) -> str:
    """CTEs {name}0.. (k, r, n, d) of the nodes by level and {name}s0.. of their siblings."""
    out = [f"{name}0 AS ({leaves})"]
    for j in range(levels):
        span = FANOUT ** j
        out.append(f"""{name}s{j} AS (SELECT k, r, coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
    coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
    FROM {name}{j} WHERE n > {span} WINDOW w AS (PARTITION BY k, r // {FANOUT} ORDER BY r))""")
        out.append(f"""{name}{j + 1} AS (SELECT k, r // {FANOUT} AS r, any_value(n) AS n, sha256(string_agg(d, '' ORDER BY r)) AS d
    FROM {name}{j} WHERE n > {span} GROUP BY k, r // {FANOUT})""")
    return ",\n".join(out)


def _fold_sql(name: str, start: str, tree: str, levels: int) -> str:
    """CTEs {name}0.. that carry (k, r, n, proof, acc, ...) of ``start`` up the levels of ``tree``."""
    out = [f"{name}0 AS ({start})"]
    for j in range(levels):
        out.append(f"""{name}{j + 1} AS (SELECT f.* REPLACE (CASE WHEN s.k IS NULL THEN f.r ELSE f.r // {FANOUT} END AS r,
    proof || coalesce(lefts || rights, '') AS proof, CASE WHEN s.k IS NULL THEN acc ELSE sha256(lefts || acc || rights) END AS acc)
    FROM {name}{j} f LEFT JOIN {tree}s{j} s ON s.k = f.k AND s.r = f.r AND f.n > {FANOUT ** j})""")
    return ",\n".join(out)


def oracle_sql(levels: int = 7, top_levels: int = 3) -> str:
    """DuckDB: the trees level by level, for up to 8^levels rows a language and 8^top_levels languages."""
    def part(x: str) -> str:
        return f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([part("doc_id"), part("source"), part("lang"), part("n_chars"), part(text)]) + ")"

    step = "list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END::UBIGINT))"
    crc = (f"xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::UBIGINT)), "
           f"lambda c, b: {step}), 4294967295::UBIGINT)")
    tops = " UNION ALL ".join(f"SELECT k, d FROM m{j} WHERE n <= {FANOUT ** j} AND n > {FANOUT ** (j - 1) if j else 0}" for j in range(levels + 1))
    return f"""
WITH d AS (SELECT doc_id, coalesce('1' || lang, '0') AS k, {leaf('text')} AS leaf,
        {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} AS lowered, {crc} % 3 = 0 AS tampered FROM documents),
e AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY k) AS n FROM d),
{_tree_sql("m", "SELECT k, r, n, leaf AS d FROM e", levels)},
subroots AS ({tops}),
g AS (SELECT k AS grp, 0 AS k, row_number() OVER (ORDER BY k) - 1 AS r, count(*) OVER () AS n, d FROM subroots),
{_tree_sql("t", "SELECT k, r, n, d FROM g", top_levels)},
{_fold_sql("f", "SELECT doc_id, leaf, k, r, n, '' AS proof, CASE WHEN tampered THEN coalesce(lowered, leaf) ELSE leaf END AS acc FROM e", "m", levels)},
{_fold_sql("h", f"SELECT f.doc_id, f.leaf, g.d AS subroot, g.k, g.r, g.n, f.proof, f.acc FROM f{levels} f JOIN g ON g.grp = f.k", "t", top_levels)},
top AS (SELECT d AS root FROM (SELECT d, n, 0 AS l FROM t0 WHERE n = 1 {''.join(f" UNION ALL SELECT d, n, {j} FROM t{j} WHERE n <= {FANOUT ** j} AND n > {FANOUT ** (j - 1)}" for j in range(1, top_levels + 1))}))
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root AS verified FROM h{top_levels}, top
"""
