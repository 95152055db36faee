"""Trees and chains of any depth: closures, paths, tree text, redirects. Cycles end at the first node that would repeat."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from archivolt.operators.widen import with_ordinals
from archivolt.session import cut


def _climb(nodes: DataFrame, ref: str, parent: str, label: str) -> DataFrame:
    """(ref, path, ids, depth) of every node by pointer doubling: after n rounds, paths of up to 2**n nodes.

    A parent that isn't among the nodes ends a path and stands in it by its own ref; a cycle ends at the first node
    that repeats. Rounds double, so a tree of depth d takes log2(d) joins, each over all nodes.
    """
    known = nodes.select(F.col(ref).alias("ref"), F.col(parent).alias("parent"), F.coalesce(F.nullif(F.trim(label), F.lit("")), F.col(ref)).alias("label"))
    known = known.groupBy("ref").agg(F.min_by(F.struct("parent", "label"), F.struct("parent", "label")).alias("x")).select("ref", "x.*")
    there = known.select(F.col("ref").alias("parent")).withColumn("exists", F.lit(True))
    up = cut(
        known.join(there, "parent", "left").select(
            "ref",
            F.when(F.col("exists"), F.col("parent")).alias("next"),
            F.when(F.col("parent").isNotNull() & F.col("exists").isNull(), F.array("parent", "label")).otherwise(F.array("label")).alias("path"),
            F.array("ref").alias("ids"),
        )
    )
    while not up.where("next IS NOT NULL").isEmpty():
        above = up.select(F.col("ref").alias("next"), F.col("next").alias("_next"), F.col("path").alias("_path"), F.col("ids").alias("_ids"))
        joined = up.join(above, "next", "left").withColumn("_loop", F.coalesce(F.arrays_overlap("ids", "_ids"), F.lit(False)))
        go = F.col("_ids").isNotNull() & ~F.col("_loop")
        up = cut(
            joined.select(
                "ref",
                F.when(go, F.col("_next")).alias("next"),
                F.when(go, F.concat("_path", "path")).otherwise(F.col("path")).alias("path"),
                F.when(go, F.concat("_ids", "ids")).otherwise(F.col("ids")).alias("ids"),
            )
        )
    return up.select("ref", "path", "ids", F.size("ids").alias("depth"))


def node_paths(nodes: DataFrame, ref: str, parent: str, label: str) -> DataFrame:
    """Path from the root to every node, labels joined by '/', and its depth (H2).

    A node without a label is named by its ref; a missing parent stands as its ref and ends the path.
    """
    return _climb(nodes, ref, parent, label).select(F.col("ref").alias(ref), F.array_join("path", "/").alias("path"), "depth")


def descendants(nodes: DataFrame, ref: str, parent: str, roots: DataFrame) -> DataFrame:
    """(root, ref, depth) of all nodes below the given roots, the roots themselves with depth 0 (H1)."""
    lines = _climb(nodes, ref, parent, ref).select("ref", F.posexplode("ids").alias("at", "root"), F.size("ids").alias("n"))
    wanted = roots.select(F.col(ref).alias("root")).distinct()
    return lines.join(wanted, "root").select("root", F.col("ref").alias(ref), (F.col("n") - F.col("at") - 1).alias("depth"))


def outside_subtrees(nodes: DataFrame, ref: str, parent: str, excluded: DataFrame) -> DataFrame:
    """Nodes that are neither excluded nor below an excluded one."""
    gone = descendants(nodes, ref, parent, excluded).select(ref).distinct()
    return nodes.join(gone, ref, "left_anti")


def paths_to_tree(rows: DataFrame, path: str, ref: str, pos: str, max_depth: int | None = None) -> DataFrame:
    """Nodes of the tree that a list of paths spans: node_path, name, depth, ref (null for implied ancestors).

    A path that comes twice takes the later ref. Blank paths are left out.
    """
    segments = F.filter(F.split(path, "/"), lambda s: F.trim(s) != "")
    given = rows.select(segments.alias("s"), F.col(ref).alias("ref"), F.col(pos).alias("p")).where("size(s) > 0")
    nodes = given.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("s")), lambda i: F.struct(F.slice("s", F.lit(1), i).alias("s"), (i == F.size("s")).alias("leaf")))).alias("n"), "ref", "p")
    out = nodes.groupBy(F.col("n.s").alias("s")).agg(F.max_by(F.when(F.col("n.leaf"), F.col("ref")), F.when(F.col("n.leaf"), F.col("p"))).alias("ref"))
    out = out.select(F.array_join("s", "/").alias("node_path"), F.element_at("s", -1).alias("name"), F.size("s").alias("depth"), "ref", "s")
    return (out.where(F.col("depth") <= max_depth) if max_depth else out).drop("s")


def render_tree(nodes: DataFrame) -> DataFrame:
    """Lines of the tree text in order: line_no, line.

    Siblings are sorted without regard to case. A node's prefix shows for each ancestor whether more siblings follow.
    """
    parent = F.regexp_replace("node_path", r"/?[^/]*$", "")
    order = Window.partitionBy("_parent").orderBy(F.lower("name"), "name")
    placed = nodes.withColumn("_parent", parent).withColumn("_i", F.row_number().over(order)).withColumn(
        "_last", F.lead("name").over(order).isNull()
    )
    lines = placed.select("node_path", "name", "depth", F.posexplode(F.transform(F.sequence(F.lit(1), "depth"), lambda i: F.array_join(F.slice(F.split("node_path", "/"), F.lit(1), i), "/"))).alias("at", "_up"))
    up = placed.select(F.col("node_path").alias("_up"), F.col("_i").alias("_ui"), F.col("_last").alias("_ul"))
    joined = lines.join(up, "_up").groupBy("node_path", "name", "depth").agg(F.array_sort(F.collect_list(F.struct("at", "_ui", "_ul"))).alias("a"))
    prefix = F.transform(F.slice("a", F.lit(1), F.size("a") - 1), lambda x: F.when(x["_ul"], "    ").otherwise("│   "))
    mark = F.when(F.element_at("a", -1)["_ul"], "└── ").otherwise("├── ")
    ranked = joined.select(F.concat(F.array_join(prefix, ""), mark, "name").alias("line"), F.transform("a", lambda x: x["_ui"]).alias("_order"))
    # ranges are numbered apart, so no task sees all lines
    return ranked.join(with_ordinals(ranked.select("_order"), "_order"), "_order").select((F.col("ordinal") + 1).cast("int").alias("line_no"), "line")


def redirect_chains(hops: DataFrame, source: str, target: str, status: str) -> DataFrame:
    """Chain of redirects from every address that redirects: url, hops (array of from, status, to), final_url, is_loop.

    ``hops`` has one hop per address; of several the smallest target counts. A chain ends where an address doesn't
    redirect or would repeat. Chains are joined end to end, so a round doubles them and n hops take log2(n) joins.
    """
    hop = hops.groupBy(F.col(source).alias("f")).agg(F.min_by(F.struct(F.col(status).alias("s"), F.col(target).alias("t")), F.struct(target, status)).alias("x")).select("f", "x.s", "x.t")
    step = F.struct(F.col("f").alias("from"), F.col("s").alias("status"), F.col("t").alias("to"))
    chains = cut(hop.where("t IS NOT NULL").select(F.col("f").alias("url"), F.array(step).alias("hops"), F.col("t").alias("at"), F.lit(False).alias("ended"), F.lit(False).alias("is_loop")))
    while True:
        live = chains.where("NOT ended")
        if live.isEmpty():
            return chains.select("url", "hops", F.col("at").alias("final_url"), "is_loop")
        on = chains.select(F.col("url").alias("at"), F.col("hops").alias("_hops"), F.col("at").alias("_at"), F.col("ended").alias("_ended"), F.col("is_loop").alias("_loop"))
        # the first hop that leads back into the chain ends it
        seen = F.concat(F.array("url"), F.transform("hops", lambda h: h["to"]))
        back = F.array_position(F.transform("_hops", lambda h: F.array_contains("_seen", h["to"])), True).cast("int")
        joined = live.join(on, "at", "left").withColumn("_seen", seen).withColumn("_back", F.coalesce(back, F.lit(0)))
        more, turns = F.col("_hops").isNotNull(), F.col("_back") > 0
        longer = joined.select(
            "url",
            F.when(~more, F.col("hops")).when(turns, F.concat("hops", F.slice("_hops", F.lit(1), F.col("_back") - 1))).otherwise(F.concat("hops", "_hops")).alias("hops"),
            F.when(~more | (F.col("_back") == 1), F.col("at")).when(turns, F.get("_hops", F.greatest(F.lit(0), F.col("_back") - 2))["to"]).otherwise(F.col("_at")).alias("at"),
            (~more | turns | F.coalesce("_ended", F.lit(False))).alias("ended"),
            (turns | F.coalesce("_loop", F.lit(False))).alias("is_loop"),
        )
        chains = cut(chains.where("ended").unionByName(longer))


def chain_text(hops) -> F.Column:
    """A chain as 'a -> b (301) | b -> c (302)' (F46)."""
    return F.array_join(F.transform(hops, lambda h: F.concat(h["from"], F.lit(" → "), h["to"], F.lit(" ("), h["status"], F.lit(")"))), " | ")


def sitemap_pages(entries: DataFrame, roots: Sequence[str]) -> DataFrame:
    """Distinct page addresses that are reached from sitemaps through sitemap indexes.

    ``entries``: sitemap, kind (sitemap or url), loc. A sitemap is visited once, however often it is listed.
    """
    spark = entries.sparkSession
    children = entries.where("kind = 'sitemap'").select("sitemap", "loc").distinct()
    seen = spark.createDataFrame([(r,) for r in sorted(set(roots))], "sitemap string")
    front = seen
    while True:
        front = cut(front.join(children, "sitemap").select(F.col("loc").alias("sitemap")).distinct().join(seen, "sitemap", "left_anti"))
        if front.isEmpty():
            break
        seen = cut(seen.unionByName(front))
    return entries.where("kind = 'url'").join(seen, "sitemap", "left_semi").select(F.col("loc").alias("url")).distinct()


def empty_folders(entries: DataFrame, path: str, is_dir: str, ignored: Sequence[str] = ()) -> DataFrame:
    """Folders with no entry but ignored ones (P15). ``ignored`` are glob patterns on names; a folder that only holds empty folders isn't empty."""
    glob = lambda g: "^" + "".join({"*": ".*", "?": "."}.get(ch, "\\" + ch if not ch.isalnum() else ch) for ch in g) + r"\z"
    name, parent = F.regexp_replace(path, r"^.*/", ""), F.regexp_replace(path, r"/[^/]*$", "")
    skip = reduce(lambda a, b: a | b, [name.rlike(glob(g)) for g in ignored], F.lit(False)) & ~F.col(is_dir)
    used = entries.where(~skip).select(parent.alias(path)).distinct()
    return entries.where(is_dir).select(path).join(used, path, "left_anti")
