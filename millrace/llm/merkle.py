"""A Merkle manifest of a table: hash trees by source below one root, and proofs by a recursive climb."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import cut, lower_ascii

#: Consecutive nodes that become one.
FANOUT = 16
#: Names of trees: a source's own one sorts as the source does (null first, then by bytes); the last one joins them all.
NULL_SOURCE, SOURCE, TOP = "n", "s", "t"
ROWS_PER_PART = 1_000_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def _hashed(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _hex(digest: Column | str) -> Column:
    return F.lower(F.hex(digest))


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hashes(docs: DataFrame) -> DataFrame:
    """doc_id, tree, leaf and tampered (null where the row is left alone) of every row."""
    row = {name: F.col(name) for name in FIELDS}
    other = row | {"text": lower_ascii("text")}
    leaf, changed = (_hashed(F.concat(*[_field(r[name]) for name in FIELDS])) for r in (row, other))
    is_changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tree = F.coalesce(F.concat(F.lit(SOURCE), F.col("source")), F.lit(NULL_SOURCE))
    return docs.select("doc_id", tree.alias("tree"), leaf.alias("leaf"), F.when(is_changed, changed).alias("tampered"))


def numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` with idx, their place within their tree by ``order``, and n, the tree's number of nodes.

    The rows are dealt out by ranges of tree and order and counted by range. A range is a part of a tree, so the
    largest tree is numbered by as many tasks as its share of the rows; the running sum sees one row per range.
    """
    parts = max(nodes.sparkSession.sparkContext.defaultParallelism, nodes.count() // ROWS_PER_PART + 1)
    dealt = cut(nodes.repartitionByRange(parts, "tree", *order).withColumn("part", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("tree", "part").agg(F.count("*").alias("here"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree", "part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("start"), F.sum("here").over(whole).alias("n")
    )
    place = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order))
    rows = dealt.withColumn("row", place).join(starts, ["tree", "part"])
    return rows.withColumn("idx", F.col("start") + F.col("row") - 1).drop("part", "row", "start")


def _joined(level: DataFrame, *kept: str) -> DataFrame:
    """Each run of ``FANOUT`` nodes as one: their hashes side by side in children, the columns ``kept`` in a list.

    A tree's lone node is not hashed again: it comes back as it is, at its level.
    """
    runs = level.groupBy("tree", "level", F.expr(f"idx div {FANOUT}").alias("idx")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("idx").alias("at"), "hash", *kept))).alias("members"), F.max("n").alias("n")
    )
    children = F.unhex(F.array_join(F.transform("members", lambda m: F.hex(m["hash"])), ""))
    is_run = F.col("n") > 1
    return runs.withColumn("children", F.when(is_run, children)).select(
        "tree",
        (F.col("level") + is_run.cast("int")).alias("level"),
        "idx",
        F.when(is_run, _hashed(_hex("children"))).otherwise(F.col("members")[0]["hash"]).alias("hash"),
        "children",
        F.ceil(F.col("n") / FANOUT).cast("long").alias("n"),
        *(["members"] if kept else []),
    )


def _levels(first: DataFrame) -> list[DataFrame]:
    """``first`` and every level above it, until each tree has come down to one node."""
    levels = [first]
    while not (several := levels[-1].where("n > 1")).isEmpty():
        levels.append(cut(_joined(several.drop("members")), "level"))
    return levels


def _linked(level: DataFrame, ranks: DataFrame) -> DataFrame:
    """Nodes with the key of their parent and their place in its run; the last node of a source links to the top tree.

    ``ranks`` has one row per tree: its place among all subroots. The root's parent is null.
    """
    below, last = level.where("n > 1"), level.where("n = 1")
    up = lambda tree, above, at, many: [
        F.when(many, tree).alias("up_tree"),
        F.when(many, above).alias("up_level"),
        F.when(many, F.expr(f"{at} div {FANOUT}")).alias("up_idx"),
        F.when(many, F.expr(f"cast({at} % {FANOUT} as int)")).alias("place"),
    ]
    inner = below.select(*level.columns, *up(F.col("tree"), F.col("level") + 1, "idx", F.lit(True)))
    outer = last.join(ranks, "tree", "left").select(*level.columns, *up(F.lit(TOP), F.lit(1), "rank", F.col("n_trees") > 1))
    return inner.unionByName(outer)


@contextmanager
def _unlimited(spark: SparkSession):
    """Spark ends a recursive query at a number of rows; ours has as many rows as the table has runs, times the levels."""
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.unset(ROW_LIMIT) if before is None else spark.conf.set(ROW_LIMIT, before)


def build_tree(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored levels: runs of leaves with their members, and all nodes above them, each row linked to its parent.

    Columns: tree, level, idx, hash, children, n (nodes of this level of this tree), up_tree, up_level, up_idx, place.
    """
    leaves = numbered(cut(leaf_hashes(docs), "leaves"), "doc_id", "leaf")
    leaves = leaves.withColumn("level", F.lit(0)).withColumnRenamed("leaf", "hash")
    levels = _levels(cut(_joined(leaves, "doc_id", "tampered"), "runs"))
    last = [level.where("n = 1").select(F.col("tree").alias("of"), "hash") for level in levels]
    subroots = last[0]
    for more in last[1:]:
        subroots = subroots.unionByName(more)
    ranked = cut(numbered(subroots.withColumn("tree", F.lit(TOP)), "of").withColumn("level", F.lit(0)), "subroots")
    ranks = ranked.select(F.col("of").alias("tree"), F.col("idx").alias("rank"), F.col("n").alias("n_trees"))
    top = _levels(cut(_joined(ranked.drop("of")), "top"))
    runs = cut(_linked(levels[0], ranks), "linked-runs")
    nodes = None
    for level in [*levels[1:], *top]:
        linked = _linked(level.where("children is not null"), ranks)
        nodes = linked if nodes is None else nodes.unionByName(linked)
    return runs, cut(nodes, "nodes")


#: Children without the hash at a place, left and right of it; a digest has 32 bytes.
_LEFT, _RIGHT = "substring({0}, 1, 32 * {1})", "substring({0}, 32 * {1} + 33)"


def _siblings(children: str, place: str) -> tuple[str, str]:
    return _LEFT.format(children, place), _RIGHT.format(children, place)


def _fold(children: str, place: str, own: str) -> str:
    left, right = _siblings(children, place)
    return f"unhex(sha2(lower(hex(concat({left}, {own}, {right}))), 256))"


#: What a leaf, as sent or tampered with, becomes among its siblings; the leaf itself if it has none.
_FIRST_FOLD = f"""transform(members, x -> CASE WHEN children IS NULL THEN coalesce(x.tampered, x.hash)
  ELSE {_fold('children', f'cast(x.at % {FANOUT} as int)', 'coalesce(x.tampered, x.hash)')} END)"""


def climb(runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row per run of leaves and step to the root: tree, idx, step, folds, siblings, subroot, root.

    A recursive query: each level joins the parent's row, folds every leaf's hash into the parent's and sends out the
    siblings met there. Leaves of a run share all siblings above the run, so they climb together; ``folds`` holds each
    of their hashes once, as all leaves that were left alone have the same. It is null but for the last step, subroot
    but for the step that reaches it. Joins with the few nodes near the root rest on AQE to split their hot keys.
    """
    up = "up_tree, up_level, up_idx, place"
    left, right = _siblings("n.children", "w.place")
    with _unlimited(runs.sparkSession):
        return cut(
            runs.sparkSession.sql(
                f"""
                WITH RECURSIVE way(tree, idx, step, folds, siblings, subroot, root, {up}) AS (
                  SELECT tree, idx, 0, array_distinct({_FIRST_FOLD}), X'', CASE WHEN n = 1 THEN hash END, hash, {up}
                  FROM {{runs}}
                  UNION ALL
                  SELECT w.tree, w.idx, w.step + 1, transform(w.folds, x -> {_fold('n.children', 'w.place', 'x')}),
                    concat({left}, {right}), CASE WHEN n.n = 1 AND n.tree <> '{TOP}' THEN n.hash END, n.hash,
                    n.up_tree, n.up_level, n.up_idx, n.place
                  FROM way w JOIN {{nodes}} n ON w.up_tree = n.tree AND w.up_level = n.level AND w.up_idx = n.idx)
                SELECT tree, idx, step, CASE WHEN up_tree IS NULL THEN folds END AS folds, siblings, subroot,
                  CASE WHEN up_tree IS NULL THEN root END AS root FROM way""",
                runs=runs,
                nodes=nodes,
            ),
            "ways",
        )


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs``.

    ``docs`` has doc_id, source, lang, n_chars and text; other columns are ignored. A null field counts as '-', a null
    source is a tree of its own that comes first. Rows that share source and doc_id follow each other by their leaf, a
    null doc_id comes first and is not tampered with. A lone row is its own root and has no siblings, an empty table an
    empty result.
    """
    runs, nodes = build_tree(docs)
    steps = F.sort_array(F.collect_list(F.struct("step", "siblings")))  # one for each level
    ways = climb(runs, nodes).groupBy("tree", "idx").agg(
        F.max("folds").alias("folds"), F.max("subroot").alias("subroot"), F.max("root").alias("root"), steps.alias("steps")
    )
    above = F.array_join(F.transform("steps", lambda s: F.hex(s["siblings"])), "")
    found = runs.select("tree", "idx", "members", F.expr(_FIRST_FOLD).alias("first")).join(ways, ["tree", "idx"])
    found = found.withColumn("above", F.lower(above)).withColumn("slots", F.array_distinct("first"))
    rows = found.selectExpr(
        "subroot", "root",
        """inline(transform(members, (x, i) -> named_struct('doc_id', x.doc_id, 'leaf', x.hash,
          'fold', folds[array_position(slots, first[i]) - 1],
          'proof_sha256', sha2(concat(array_join(transform(filter(members, (y, k) -> k <> i), y -> lower(hex(y.hash))), ''),
            above), 256))))""",
    )
    return rows.select(
        "doc_id", _hex("leaf").alias("leaf"), _hex("subroot").alias("subroot"), _hex("root").alias("root"), "proof_sha256",
        _hex("fold").alias("folded_root"), (F.col("fold") == F.col("root")).alias("verified"),
    )
