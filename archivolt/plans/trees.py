"""Queries on hierarchies, paths and chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from archivolt.operators import fixity, hierarchy, pivot
from archivolt.plans.base import Registry
from archivolt.session import table

query = Registry()

_UP = """
RECURSIVE n AS (SELECT ref, parent, coalesce(nullif(trim(title), ''), ref) AS label FROM entity_folder),
up AS (
  SELECT ref, [label] AS path, [ref] AS ids, parent AS nxt FROM n
  UNION ALL
  SELECT up.ref, [n.label] || up.path, [n.ref] || up.ids, n.parent FROM up JOIN n ON up.nxt = n.ref WHERE NOT list_contains(up.ids, n.ref)),
done AS (
  SELECT ref, CASE WHEN nxt IS NOT NULL AND nxt NOT IN (SELECT ref FROM n) THEN [nxt] || path ELSE path END AS path, ids, len(ids) AS depth
  FROM up QUALIFY row_number() OVER (PARTITION BY ref ORDER BY len(ids) DESC) = 1)
"""


@query(f"WITH {_UP} SELECT ref, array_to_string(path, '/') AS path, CAST(depth AS INT) AS depth FROM done")
def hierarchy_paths(spark, d):
    """H2: path from the root; a missing parent ends it."""
    return hierarchy.node_paths(table(spark, d, "entity_folder"), "ref", "parent", "title")


@query(
    f"""WITH {_UP}, roots AS (SELECT ref FROM n WHERE parent IS NULL), l AS (SELECT ref, ids, unnest(ids) AS root, generate_subscripts(ids, 1) AS i FROM done)
SELECT root, ref, CAST(len(ids) - i AS INT) AS depth FROM l WHERE root IN (SELECT ref FROM roots)"""
)
def descendant_closure(spark, d):
    """H1: all nodes below the top folders."""
    folders = table(spark, d, "entity_folder")
    return hierarchy.descendants(folders, "ref", "parent", folders.where("parent IS NULL"))


@query(f"WITH {_UP} SELECT ref, title FROM entity_folder WHERE ref NOT IN (SELECT ref FROM done WHERE list_has_any(ids, (SELECT list(ref) FROM n WHERE label IN ('Web', 'Branches'))))")
def subtree_exclusion(spark, d):
    """Nodes outside two folders and all below them."""
    folders = table(spark, d, "entity_folder")
    return hierarchy.outside_subtrees(folders.select("ref", "parent", "title"), "ref", "parent", folders.where("title IN ('Web', 'Branches')")).select("ref", "title")


_TREE = """
s AS (SELECT list_filter(string_split(preservica_path, '/'), lambda x: trim(x) <> '') AS s, asset_id AS ref, record_id AS p FROM metadata_export WHERE preservica_path IS NOT NULL),
x AS (SELECT s[1:i] AS s, i = len(s) AS leaf, ref, p FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM s)),
tree AS (SELECT array_to_string(s, '/') AS node_path, s[-1] AS name, CAST(len(s) AS INT) AS depth, arg_max(ref, p) FILTER (leaf) AS ref FROM x GROUP BY s)
"""


@query(f"WITH {_TREE} SELECT * FROM tree")
def path_tree(spark, d):
    """H4, H7: the tree that all paths span."""
    return hierarchy.paths_to_tree(table(spark, d, "metadata_export"), "preservica_path", "asset_id", "record_id")


@query(f"WITH {_TREE} SELECT * FROM tree WHERE depth = 2")
def path_tree_level(spark, d):
    """Nodes of one level."""
    return hierarchy.paths_to_tree(table(spark, d, "metadata_export"), "preservica_path", "asset_id", "record_id", max_depth=2).where("depth = 2")


@query(f"WITH {_TREE} SELECT * FROM tree WHERE depth <= 2")
def path_tree_depth(spark, d):
    """P21."""
    return hierarchy.paths_to_tree(table(spark, d, "metadata_export"), "preservica_path", "asset_id", "record_id", max_depth=2)


@query(
    f"""WITH {_UP},
s AS (SELECT list_filter(string_split(array_to_string(path, '/'), '/'), lambda x: trim(x) <> '') AS s FROM done),
nodes AS (SELECT DISTINCT s[1:i] AS s FROM (SELECT s, unnest(range(1, len(s) + 1)) AS i FROM s)),
placed AS (
  SELECT s, s[1:len(s) - 1] AS above, s[-1] AS name, row_number() OVER w AS i, lead(s) OVER w IS NULL AS last
  FROM nodes WINDOW w AS (PARTITION BY s[1:len(s) - 1] ORDER BY lower(s[-1]), s[-1])),
drawn AS (
  SELECT s, [i] AS k, CASE WHEN last THEN '    ' ELSE '│   ' END AS below, CASE WHEN last THEN '└── ' ELSE '├── ' END || name AS line FROM placed WHERE len(above) = 0
  UNION ALL
  SELECT p.s, list_append(d.k, p.i), d.below || CASE WHEN p.last THEN '    ' ELSE '│   ' END, d.below || CASE WHEN p.last THEN '└── ' ELSE '├── ' END || p.name FROM drawn d JOIN placed p ON p.above = d.s)
SELECT CAST(row_number() OVER (ORDER BY k) AS INT) AS line_no, line FROM drawn"""
)
def folder_tree_text(spark, d):
    """The folders as indented text."""
    paths = hierarchy.node_paths(table(spark, d, "entity_folder"), "ref", "parent", "title").withColumn("pos", F.col("ref"))
    return hierarchy.render_tree(hierarchy.paths_to_tree(paths, "path", "ref", "pos"))


@query(
    r"""WITH RECURSIVE hops AS (
  SELECT asset_id AS f, min((regexp_extract(dc_relation, 'IsVersionOf:([0-9a-f-]{36})', 1), '301')) AS x FROM metadata_export WHERE regexp_matches(dc_relation, 'IsVersionOf:[0-9a-f-]{36}') GROUP BY ALL),
h AS (SELECT f, x[1] AS t, x[2] AS s FROM hops),
c AS (
  SELECT f AS url, [f, t] AS seen, t AS final_url, f || ' → ' || t || ' (' || s || ')' AS chain, 1 AS n FROM h
  UNION ALL
  SELECT c.url, list_append(c.seen, h.t), h.t, c.chain || ' | ' || h.f || ' → ' || h.t || ' (' || h.s || ')', c.n + 1 FROM c JOIN h ON c.final_url = h.f WHERE NOT list_contains(c.seen, h.t)),
last AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY url ORDER BY n DESC) = 1)
SELECT url, chain, final_url, EXISTS (SELECT 1 FROM h WHERE h.f = last.final_url AND list_contains(last.seen, h.t)) AS is_loop FROM last"""
)
def redirect_chain(spark, d):
    """Chains of versions, with a guard against cycles."""
    target = F.regexp_extract("dc_relation", "IsVersionOf:([0-9a-f-]{36})", 1)
    hops = table(spark, d, "metadata_export").select(F.col("asset_id").alias("source"), target.alias("target"), F.lit("301").alias("status")).where("target <> ''")
    chains = hierarchy.redirect_chains(hops, "source", "target", "status")
    return chains.select("url", hierarchy.chain_text(F.col("hops")).alias("chain"), "final_url", "is_loop")


_ENTRIES = r"""
folders AS (SELECT DISTINCT regexp_replace(preservica_path, '/[^/]*$', '') AS path FROM metadata_export WHERE preservica_path IS NOT NULL),
entries AS (
  SELECT path, true AS is_dir FROM folders UNION ALL
  SELECT preservica_path, false FROM metadata_export WHERE preservica_path IS NOT NULL AND filename IS NOT NULL)
"""


def _entries(spark, d):
    rows = table(spark, d, "metadata_export").where("preservica_path IS NOT NULL")
    folders = rows.select(F.regexp_replace("preservica_path", "/[^/]*$", "").alias("path")).distinct().withColumn("is_dir", F.lit(True))
    return folders.unionByName(rows.where("filename IS NOT NULL").select(F.col("preservica_path").alias("path"), F.lit(False).alias("is_dir")))


@query(
    rf"""WITH {_ENTRIES}, used AS (SELECT DISTINCT regexp_replace(path, '/[^/]*$', '') AS path FROM entries WHERE is_dir OR NOT regexp_matches(regexp_replace(path, '^.*/', ''), '^.*a.*$'))
SELECT path FROM entries WHERE is_dir AND path NOT IN (SELECT path FROM used)"""
)
def empty_folders(spark, d):
    """Folders with nothing but ignored entries."""
    return hierarchy.empty_folders(_entries(spark, d), "path", "is_dir", ["*a*"])


@query(
    rf"""WITH {_ENTRIES}, e AS (SELECT path, bool_or(is_dir) AS is_dir FROM entries GROUP BY ALL), used AS (SELECT DISTINCT regexp_replace(path, '/[^/]*$', '') AS path FROM e),
p AS (SELECT DISTINCT preservica_path AS path FROM metadata_export WHERE preservica_path IS NOT NULL)
SELECT p.path, CASE WHEN e.path IS NULL THEN 'missing' WHEN NOT e.is_dir THEN 'file' WHEN used.path IS NULL THEN 'empty_folder' ELSE 'full_folder' END AS decision
FROM p LEFT JOIN e USING (path) LEFT JOIN used ON p.path = used.path"""
)
def deletion_plan(spark, d):
    """What deleting each path would do."""
    inventory = _entries(spark, d).groupBy("path").agg(F.max("is_dir").alias("is_dir")).withColumn("is_link", F.lit(False))
    return fixity.deletion_plan(table(spark, d, "metadata_export").where("preservica_path IS NOT NULL").select(F.col("preservica_path").alias("path")), inventory, "path")


@query(
    r"""WITH f AS (SELECT regexp_replace(preservica_path, '/?[^/]*$', '') AS folder, regexp_replace(preservica_path, '^.*/', '') AS name FROM metadata_export WHERE preservica_path IS NOT NULL)
SELECT folder, string_agg(name || ' [' || CASE WHEN contains(lower(name), 'opex') THEN 'metadata' ELSE 'content' END || ']', '; ' ORDER BY name) AS files FROM f GROUP BY ALL"""
)
def folder_manifests(spark, d):
    """Files of each folder with their kind."""
    lists = pivot.folder_manifests(table(spark, d, "metadata_export").where("preservica_path IS NOT NULL"), "preservica_path")
    return lists.select("folder", F.array_join(F.transform("files", lambda x: F.concat(x["name"], F.lit(" ["), x["kind"], F.lit("]"))), "; ").alias("files"))


@query(
    """WITH RECURSIVE e AS (SELECT coalesce(parent, 'root') AS sitemap, ref AS loc FROM entity_folder),
seen AS (SELECT 'root' AS s UNION SELECT e.loc FROM seen JOIN e ON e.sitemap = seen.s)
SELECT DISTINCT asset_id AS url FROM metadata_export WHERE parent_ref IN (SELECT s FROM seen) AND asset_id IS NOT NULL"""
)
def sitemap_pages(spark, d):
    """Pages reached through nested indexes; folders stand for indexes, assets for pages."""
    index = table(spark, d, "entity_folder").select(F.coalesce("parent", F.lit("root")).alias("sitemap"), F.lit("sitemap").alias("kind"), F.col("ref").alias("loc"))
    pages = table(spark, d, "metadata_export").where("asset_id IS NOT NULL").select(F.col("parent_ref").alias("sitemap"), F.lit("url").alias("kind"), F.col("asset_id").alias("loc"))
    return hierarchy.sitemap_pages(index.unionByName(pages), ["root"])
