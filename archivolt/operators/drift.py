"""Schemas that drift between files: a minimum-cost edit script per file and its forerunner, one consistent table.

A schema is an unordered tree: namespaces or structs are inner nodes, fields are leaves, whatever the depth. Between two
successive schemas ``tree_mapping`` finds a cheapest mapping under the constrained tree edit distance (disjoint subtrees
map to disjoint subtrees, which makes it polynomial): inner nodes and fields are added, deleted or renamed. Subtrees and fields
that it leaves over on both sides are then matched as moves by a cheapest assignment, and fields that stay but
changed their kind of value are retyped. A field may only go over into another name where values live on under it, which is
found by an equality join on asset and value. Scripts compile into projections: for CSV records into the positions
that feed each column of the consistent table, for nested DataFrames into a ``select``.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field as dataclass_field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archivolt.functions.text import strip
from archivolt.session import kept as keep

#: One CSV cell after a comma: quoted (a stop must follow) or bare. Possessive, so long cells need no stack.
_CELL = r',("[^"]*+(?:""[^"]*+)*+"(?=,|\z)|[^,]*+)'

#: Share of the values that must live on for a field to count as renamed.
LIVES_ON = 0.5
#: Costs: a field, an inner node, a move, another kind of value, another name of an inner node.
FIELD, INNER, MOVE, RETYPE, RELABEL = 1.0, 0.1, 0.25, 0.5, 0.05
_NEVER = 1e6


def split_record(line: Column) -> Column:
    """Cells of one CSV record; a quoted cell may hold commas, quotes and line breaks."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), F.rtrim(line, F.lit("\r\n"))), F.lit(_CELL), F.lit(1))
    quoted = lambda c: F.startswith(c, F.lit('"')) & F.endswith(c, F.lit('"')) & (F.length(c) > 1)
    return F.transform(cells, lambda c: F.when(quoted(c), F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))


def field_name(cell: Column) -> Column:
    """Field name as it is compared: lower case, without byte order mark and surrounding blanks."""
    return F.lower(strip(F.replace(cell, F.lit("﻿"), F.lit(""))))


#: Kinds of value in the order of their codes.
KINDS = ("whole", "decimal", "date", "several", "text")


def value_kind(value: Column) -> Column:
    """Code of the kind of a filled, stripped cell."""
    v, (whole, decimal, date, several, text) = value, map(F.lit, range(len(KINDS)))
    many = F.when((F.contains(v, F.lit(";")) | F.contains(v, F.lit("|"))) & v.rlike(r"(?s)[^;|\s][^;|]*[;|]\s*[^;|\s]"), several).otherwise(text)
    return F.when(F.substring(v, 1, 1) > "9", many).otherwise(  # no higher first character can begin a number
        F.when(v.rlike(r"^[+-]?[0-9]+\z"), whole).when(v.rlike(r"^[+-]?[0-9]*[.][0-9]+\z"), decimal).when(v.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), date).otherwise(many)
    )


# --- trees and their edit scripts ------------------------------------------------------------------------------------


@dataclass(eq=False)
class Node:
    """A node of a schema tree. ``path`` is its whole name for a field and its place for an inner node."""

    label: str
    path: str
    is_field: bool = False
    parent: "Node | None" = None
    children: list["Node"] = dataclass_field(default_factory=list)

    def add(self, child: "Node") -> "Node":
        child.parent = self
        self.children.append(child)
        return child

    def walk(self) -> Iterator["Node"]:
        yield self
        for c in self.children:
            yield from c.walk()


def name_tree(fields: Sequence[str]) -> Node:
    """Tree of flat names such as ``dc:subject`` or ``entity.title.lang``; every colon or dot opens a level."""
    root, inner = Node("", ""), {}
    for name in sorted(set(fields)):
        at, start = root, 0
        for i in range(1, len(name) - 1):
            if name[i] in ":." and i > start:
                prefix = name[: i + 1]
                at = inner.get(prefix) or inner.setdefault(prefix, at.add(Node(name[start : i + 1], prefix)))
                start = i + 1
        at.add(Node(name[start:], name, True))
    return root


def struct_tree(schema: T.StructType) -> Node:
    """Tree of a Spark schema; structs are inner nodes, anything else a field (an array or map of structs, too)."""

    def fill(node: Node, struct: T.StructType, prefix: str) -> Node:
        for f in struct.fields:
            child = node.add(Node(f.name, prefix + f.name, not isinstance(f.dataType, T.StructType)))
            if not child.is_field:
                fill(child, f.dataType, child.path + ".")
        return node

    return fill(Node("", ""), schema, "")


def least_assignment(cost: Sequence[Sequence[float]]) -> list[int]:
    """Column of each row in a cheapest complete assignment of a square matrix (Hungarian method)."""
    n = len(cost)
    u, v, match, way = [0.0] * (n + 1), [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for row in range(1, n + 1):
        match[0], col = row, 0
        least, used = [float("inf")] * (n + 1), [False] * (n + 1)
        while True:
            used[col] = True
            r, delta, to = match[col], float("inf"), 0
            for c in range(1, n + 1):
                if not used[c]:
                    if (x := cost[r - 1][c - 1] - u[r] - v[c]) < least[c]:
                        least[c], way[c] = x, col
                    if least[c] < delta:
                        delta, to = least[c], c
            for c in range(n + 1):
                if used[c]:
                    u[match[c]] += delta
                    v[c] -= delta
                else:
                    least[c] -= delta
            col = to
            if match[col] == 0:
                break
        while col:
            match[col] = match[way[col]]
            col = way[col]
    out = [0] * n
    for c in range(1, n + 1):
        out[match[c] - 1] = c - 1
    return out


def match_or_leave(pair: Sequence[Sequence[float]], leave: Sequence[float], come: Sequence[float]) -> tuple[float, list[tuple[int, int]]]:
    """(cost, matched pairs) of a cheapest matching in which every row and column may stay alone at its own cost."""
    n, m = len(leave), len(come)
    if not n or not m:
        return sum(leave) + sum(come), []
    cost = [[*pair[i], *(leave[i] if i == k else _NEVER for k in range(n))] for i in range(n)]
    cost += [[*(come[j] if j == k else _NEVER for k in range(m)), *[0.0] * n] for j in range(m)]
    to = least_assignment(cost)
    return sum(cost[i][j] for i, j in enumerate(to)), [(i, to[i]) for i in range(n) if to[i] < m]


class TreeDistance:
    """Constrained edit distance of two unordered trees, with the mapping that attains it.

    Equal fields in equal places map to themselves at no cost and are set aside first, which never makes a script dearer; the
    rest is as small as what changed.
    """

    def __init__(self, before: Node, after: Node, lives_on: Mapping[tuple[str, str], float], trust_labels: bool = False):
        self.lives_on, self.trust_labels, self.same = lives_on, trust_labels, []
        #: inner nodes that hold what stayed, and so must map to each other
        self.pinned: dict[Node, Node] = {}
        self.before, self.after = self._without_same(before, after)
        self._weight, self._tree, self._forest = {}, {}, {}

    def _without_same(self, a: Node, b: Node) -> tuple[Node, Node]:
        x, y = Node(a.label, a.path, a.is_field), Node(b.label, b.path, b.is_field)
        there = {(c.label, c.is_field): c for c in b.children}
        for c in a.children:
            d = there.pop((c.label, c.is_field), None)
            if d is None:
                x.add(c)
            elif c.is_field:
                self.same.append((c, d))
            else:
                known = len(self.same)
                p, q = self._without_same(c, d)
                if p.children or q.children:
                    x.add(p)
                    y.add(q)
                    if len(self.same) > known:
                        self.pinned |= {p: q, q: p}
        for d in there.values():
            y.add(d)
        return x, y

    def weight(self, n: Node) -> float:
        """Cost of adding or deleting a whole subtree."""
        if n not in self._weight:
            own = _NEVER if n in self.pinned else FIELD if n.is_field else INNER
            self._weight[n] = own + sum(map(self.weight, n.children))
        return self._weight[n]

    def relabel(self, a: Node, b: Node) -> float:
        if a.is_field != b.is_field or self.pinned.get(a, b) is not b or self.pinned.get(b, a) is not a:
            return _NEVER
        if not a.is_field:
            return 0.0 if a.label == b.label else RELABEL
        share = self.lives_on.get((a.path, b.path), 1.0 if self.trust_labels and a.label == b.label else 0.0)
        if share < LIVES_ON:
            return _NEVER
        return 1.0 - share + (0.0 if a.label == b.label else RELABEL)

    def forest(self, a: Node, b: Node) -> tuple[float, list[tuple[Node, Node]]]:
        """Distance and mapping of the children of a and b."""
        if (a, b) not in self._forest:
            wa, wb = [self.weight(c) for c in a.children], [self.weight(c) for c in b.children]
            trees = [[self.tree(c, d) for d in b.children] for c in a.children]
            cost, pairs = match_or_leave([[t[0] for t in row] for row in trees], wa, wb)
            best = (cost, [p for i, j in pairs for p in trees[i][j][1]])
            for d, w in zip(b.children, wb):  # all of a's children below one child of b
                if d.children:
                    c, m = self.forest(a, d)
                    best = min(best, (sum(wb) - w + INNER + c, m), key=lambda t: t[0])
            for x, w in zip(a.children, wa):
                if x.children:
                    c, m = self.forest(x, b)
                    best = min(best, (sum(wa) - w + INNER + c, m), key=lambda t: t[0])
            self._forest[a, b] = best
        return self._forest[a, b]

    def tree(self, a: Node, b: Node) -> tuple[float, list[tuple[Node, Node]]]:
        """Distance and mapping of the subtrees of a and b."""
        if (a, b) not in self._tree:
            change = self.relabel(a, b)
            best = (self.weight(a) + self.weight(b), [])
            if change < _NEVER:
                c, m = self.forest(a, b)
                best = min(best, (change + c, [(a, b), *m]), key=lambda t: t[0])
            for d in b.children:  # b's root is new
                c, m = self.tree(a, d)
                best = min(best, (self.weight(b) - self.weight(d) + c, m), key=lambda t: t[0])
            for x in a.children:
                c, m = self.tree(x, b)
                best = min(best, (self.weight(a) - self.weight(x) + c, m), key=lambda t: t[0])
            self._tree[a, b] = best
        return self._tree[a, b]

    def mapping(self) -> dict[Node, Node]:
        """The cheapest mapping with moves.

        Inner nodes map as in the tree edit distance; what it leaves over of them on both sides is matched as moved subtrees.
        Under that mapping of inner nodes the fields are then assigned at least cost, a field that leaves its node paying
        for the move.
        """
        kept = dict([(self.before, self.after), *self.forest(self.before, self.after)[1]])
        taken = set(kept.values())
        # only whole subtrees of which nothing is matched yet
        gone = [n for n in self.before.walk() if not n.is_field and all(k not in kept for k in n.walk())]
        come = [n for n in self.after.walk() if not n.is_field and all(k not in taken for k in n.walk())]
        cost = [[self.tree(a, b)[0] + MOVE if self.relabel(a, b) < _NEVER else _NEVER for b in come] for a in gone]
        for i, j in match_or_leave(cost, [self.weight(n) for n in gone], [self.weight(n) for n in come])[1]:
            part = self.tree(gone[i], come[j])[1]
            if part and all(a not in kept and b not in taken for a, b in part):
                kept.update(part)
                taken.update(b for _, b in part)
        kept = {a: b for a, b in kept.items() if not a.is_field}
        gone, come = ([n for n in t.walk() if n.is_field] for t in (self.before, self.after))
        leaf = lambda a, b: self.relabel(a, b) + (0.0 if kept.get(a.parent) is b.parent else MOVE)
        pairs = match_or_leave([[leaf(a, b) for b in come] for a in gone], [FIELD] * len(gone), [FIELD] * len(come))[1]
        return kept | {gone[i]: come[j] for i, j in pairs}


@dataclass(frozen=True)
class Step:
    """One operation of an edit script: add, delete, rename, move or retype of a field or inner node."""

    op: str
    before: str
    after: str
    is_field: bool = True


def edit_script(
    before: Sequence[str] | Node,
    after: Sequence[str] | Node,
    lives_on: Mapping[tuple[str, str], float],
    kinds_before: Mapping[str, str] | None = None,
    kinds_after: Mapping[str, str] | None = None,
    trust_labels: bool = False,
) -> list[Step]:
    """Cheapest script that turns one schema tree into the other, sorted. Kinds of value are given by field.

    A field whose inner nodes were renamed around it is renamed, too, as its whole name changed. Equal costs resolve by
    name. With ``trust_labels`` a field counts as living on under the same last name elsewhere even if no values are
    known. Two empty schemas have an empty script.
    """
    a, b = (x if isinstance(x, Node) else name_tree(x) for x in (before, after))
    distance = TreeDistance(a, b, lives_on, trust_labels)
    kept = distance.mapping()
    steps, to = [], set(kept.values())
    for x in distance.before.walk():
        if x is distance.before:
            continue
        y = kept.get(x)
        if y is None:
            steps.append(Step("delete", x.path, "", x.is_field))
        elif kept.get(x.parent) is not y.parent:
            steps.append(Step("move", x.path, y.path, x.is_field))
        elif x.path != y.path:
            steps.append(Step("rename", x.path, y.path, x.is_field))
    steps += [Step("add", "", y.path, y.is_field) for y in distance.after.walk() if y not in to]
    if kinds_before and kinds_after:
        for f, _ in distance.same:
            if kinds_before.get(f.path) and kinds_after.get(f.path) and kinds_before[f.path] != kinds_after[f.path]:
                steps.append(Step("retype", f.path, f.path))
    return sorted(steps, key=lambda s: (s.op, s.before, s.after))


# --- CSV files -------------------------------------------------------------------------------------------------------


def read_files(lines: DataFrame) -> DataFrame:
    """Files of a table of raw lines, in the order of their series.

    Columns: series_name, file_name, file_ord, before (file exported before it in its series), names (header cells), fields (distinct,
    sorted), then (fields of the file before), and slots: one (field, at, goes, comes) per header cell, the field '' and its place in ``fields``, ``at``, -1 where it has no name, where
    ``goes`` says that the next file lacks the field and ``comes`` that the file before did. A file without a header line
    has no row.
    """
    header = F.transform(split_record(F.col("raw_line")), field_name)
    headers = (
        lines.where("line_no = 0 AND raw_line IS NOT NULL")
        .groupBy("series_name", "file_name")
        .agg(F.min(F.struct("exported_at", "raw_line")).alias("h"))
        .select("series_name", "file_name", F.col("h.exported_at").alias("exported_at"), F.col("h.raw_line").alias("raw_line"))
        .select("series_name", "file_name", "exported_at", header.alias("names"))
        .withColumn("fields", F.array_sort(F.array_distinct(F.filter("names", lambda n: n != ""))))
    )
    in_order = Window.partitionBy("series_name").orderBy("exported_at", "file_name")
    placed = headers.select(
        "series_name",
        "file_name",
        F.row_number().over(in_order).alias("file_ord"),
        F.lag("file_name").over(in_order).alias("before"),
        F.lead("file_name").over(in_order).alias("after"),
        "names",
        "fields",
        F.lag("fields").over(in_order).alias("then"),
        F.lead("fields").over(in_order).alias("next"),
    )
    slots = F.transform(
        "names",
        lambda n: F.struct(
            n.alias("field"),
            (F.array_position("fields", n).cast("int") - 1).alias("at"),
            (F.coalesce(~F.array_contains("next", n), F.lit(False)) & (n != "")).alias("goes"),
            (F.coalesce(~F.array_contains("then", n), F.lit(False)) & (n != "")).alias("comes"),
        ),
    )
    return placed.select("series_name", "file_name", "file_ord", "before", "after", "names", "fields", "then", slots.alias("slots"))


def read_rows(lines: DataFrame, files: DataFrame, *columns: str) -> DataFrame:
    """Records with their cells and the given columns of their file: series_name, file_name, line_no, row, columns."""
    named = files.select("series_name", "file_name", *columns)
    rows = lines.where("line_no > 0 AND raw_line IS NOT NULL").join(named, ["series_name", "file_name"])
    return rows.select("series_name", "file_name", "line_no", split_record(F.col("raw_line")).alias("row"), *columns)


def let(value: Column, f) -> Column:
    """f(value) with ``value`` computed once a row; the optimizer would otherwise copy its expression to every use, into loops, too."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _tokens(value: Column) -> Column:
    """Values of a cell in a form that outlives repacking and another notation of a number."""
    return F.filter(
        F.transform(F.split(value, r"[;|]"), lambda v: F.regexp_replace(F.lower(strip(v)), r"^([0-9]+)[.]0+\z", "$1")), lambda v: v != ""
    )


def field_kinds(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Filled cells by field and kind of value: series_name, file_name, counts (array of numbers).

    Cells are counted by 8 times the place of their field in the file's list plus the code of their kind; in the array
    stands that number times 2**40, plus the count.
    """
    rows = read_rows(lines, files.withColumn("at", F.col("slots.at")), "at")
    codes = F.zip_with("at", "row", lambda i, v: let(strip(v), lambda x: F.when((x != "") & (i >= 0), i * 8 + value_kind(x))))
    cells = rows.select("series_name", "file_name", F.explode(codes).alias("code")).where("code IS NOT NULL")
    # a file has as many rows here as fields and kinds, whatever its length
    counts = cells.groupBy("series_name", "file_name", "code").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("series_name", "file_name").agg(F.collect_list(F.col("code").cast("long") * (1 << 40) + F.col("n")).alias("counts"))


def rename_evidence(lines: DataFrame, files: DataFrame, asset_field: str = "assetid") -> DataFrame:
    """Values that live on: series_name, file_name, hints (array of pair of fields and number of values).

    Only fields the later file lacks and fields it adds take part, on assets with such values in both files, as a blank on either
    side says nothing. A pair with one field gives the number of values it has there.
    """
    cells = read_rows(lines, files.where(F.exists("slots", lambda s: s["goes"] | s["comes"])), "slots", "after")

    def moved(row: Column) -> Column:
        asset = F.get(F.array_compact(F.zip_with("slots", row, lambda s, v: F.when(s["field"] == asset_field, F.nullif(strip(v), F.lit(""))))), F.lit(0))
        cell = lambda s, v: F.when(s["goes"] | s["comes"], F.struct(s["at"].alias("at"), s["goes"].alias("goes"), s["comes"].alias("comes"), v.alias("value")))
        return F.struct(asset.alias("asset"), F.array_compact(F.zip_with("slots", row, cell)).alias("cells"))

    # surplus cells have no slot
    kept = cells.select("series_name", "file_name", "after", let(F.col("row"), moved).alias("m")).where("m.asset IS NOT NULL")
    changed = kept.select("series_name", "file_name", "after", F.col("m.asset").alias("asset"), F.explode("m.cells").alias("c"))
    side = F.explode(
        F.filter(
            F.array(
                F.when(F.col("c.goes"), F.struct(F.col("after").alias("file_name"), F.lit(0).alias("side"))),
                F.when(F.col("c.comes"), F.struct(F.col("file_name").alias("file_name"), F.lit(1).alias("side"))),
            ),
            lambda x: x.isNotNull(),
        )
    )
    tokens = changed.select("series_name", side.alias("p"), "asset", F.col("c.at").alias("at"), F.explode(_tokens(F.col("c.value"))).alias("token"))
    own = lambda s: F.collect_set(F.when(F.col("p.side") == s, F.col("at")))
    # the sets are as wide as the change of a schema, whatever the number of rows
    shared = tokens.groupBy("series_name", F.col("p.file_name").alias("file_name"), "asset", "token").agg(own(0).alias("gone"), own(1).alias("come"))
    both = shared.groupBy("series_name", "file_name", "asset").agg(F.max(F.size("gone")).alias("g"), F.max(F.size("come")).alias("c")).where("g > 0 AND c > 0")
    kept = shared.join(both.drop("g", "c"), ["series_name", "file_name", "asset"])
    # a pair of fields as one number, the place in either list plus one, 0 for none
    pairs = F.concat(
        F.transform("gone", lambda g: (g.cast("long") + 1) * (1 << 20)),
        F.transform("come", lambda c: c.cast("long") + 1),
        F.flatten(F.transform("gone", lambda g: F.transform("come", lambda c: (g.cast("long") + 1) * (1 << 20) + c + 1))),
    )
    counted = kept.select("series_name", "file_name", F.explode(pairs).alias("x")).groupBy("series_name", "file_name", "x").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("series_name", "file_name").agg(F.collect_list(F.struct("x", "n")).alias("hints"))


def shares(hints, then: Sequence[str], now: Sequence[str]) -> dict[tuple[str, str], float]:
    """Share of values that live on, of the field with fewer values, by field before and after."""
    n = {divmod(h["x"], 1 << 20): h["n"] for h in hints}
    return {(then[a - 1], now[b - 1]): k / min(n[a, 0], n[0, b]) for (a, b), k in n.items() if a and b}


def main_kinds(counts, fields: Sequence[str]) -> dict[str, str]:
    """Kind of more than half of a field's filled cells, by field."""
    by: dict[str, dict[str, int]] = {}
    for c in counts.tolist():
        by.setdefault(fields[c >> 43], {})[KINDS[c >> 40 & 7]] = c & (1 << 40) - 1
    top = {f: max(k.items(), key=lambda x: x[1]) for f, k in by.items()}
    return {f: kind for f, (kind, n) in top.items() if 2 * n > sum(by[f].values())}


def edit_scripts(files: DataFrame, evidence: DataFrame, kinds: DataFrame | None = None) -> DataFrame:
    """Edit scripts of all files that have a forerunner: series_name, file_name, file_ord, op, field_before, field_after, is_field."""
    keys = ["series_name", "file_name"]
    known = files.select(*keys, "file_ord", "before", "fields", "then").join(evidence, keys, "left")
    if kinds is None:
        pairs = known.withColumn("counts", F.lit(None)).withColumn("counts_then", F.lit(None))
    else:
        in_order = Window.partitionBy("series_name").orderBy("file_ord")
        pairs = known.join(kinds, keys, "left").withColumn("counts_then", F.lag("counts").over(in_order))
    pairs = pairs.where("before IS NOT NULL")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for series, file, ord_, now, then, hints, n, n_then in b.itertuples(index=False):
                typed = n is not None and n_then is not None
                kinds_then, kinds_now = (main_kinds(n_then, then), main_kinds(n, now)) if typed else ({}, {})
                if len(now) == len(then) and (now == then).all() and kinds_then == kinds_now:
                    continue
                script = edit_script(list(then), list(now), {} if hints is None else shares(hints, then, now), kinds_then, kinds_now)
                rows += [(series, file, ord_, s.op, s.before, s.after, s.is_field) for s in script]
            yield pd.DataFrame(rows, columns=["series_name", "file_name", "file_ord", "op", "field_before", "field_after", "is_field"])

    return pairs.select(*keys, "file_ord", "fields", "then", "hints", "counts", "counts_then").mapInPandas(
        run, "series_name string, file_name string, file_ord int, op string, field_before string, field_after string, is_field boolean"
    )


def schema_changes(lines: DataFrame, asset_field: str = "assetid") -> DataFrame:
    """Every change between a file and the file exported before it: file_name, change_kind, field_before, field_after.

    ``change_kind`` is added, removed, renamed or retyped. Repeated rows count as often as they stand there; null
    lines and empty files give nothing; the first file of a series has no changes. ``asset_field`` names the column that
    tells which records of two files belong together; without it nothing counts as renamed.
    """
    files = keep(read_files(lines), "files")
    script = edit_scripts(files, rename_evidence(lines, files, asset_field), field_kinds(lines, files)).where("is_field")
    kind = F.when(F.col("op") == "add", "added").when(F.col("op") == "delete", "removed").when(F.col("op") == "retype", "retyped").otherwise("renamed")
    return script.select("file_name", kind.alias("change_kind"), "field_before", "field_after")


def projections(files: DataFrame, script: DataFrame) -> DataFrame:
    """What each header cell of a file feeds: series_name, file_name, feeds (canonical names, '' for a cell without a name).

    A field keeps the name under which its series first had it, through all renames and moves. Only renames, a few
    rows a series, go through one fold per series; each field then takes the last event before its file, in order.
    """

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        out, now = [], {}
        for ord_, part in rows.sort_values(["file_ord", "field_before"]).groupby("file_ord", sort=True):
            names = {after: now.get(before, before) for before, after in zip(part.field_before, part.field_after)}
            for before in part.field_before:
                if now.pop(before, None) is not None:
                    out.append((rows.series_name.iloc[0], before, int(ord_), 0, None))
            now.update(names)
            out += [(rows.series_name.iloc[0], after, int(ord_), 1, canonical) for after, canonical in names.items()]
        return pd.DataFrame(out, columns=["series_name", "field", "file_ord", "starts", "canonical"])

    schema = "series_name string, field string, file_ord int, starts int, canonical string"
    events = script.where("is_field AND op IN ('rename', 'move')").groupBy("series_name").applyInPandas(fold, schema)
    cells = files.select("series_name", "file_ord", "file_name", F.posexplode("slots").alias("pos", "s")).select("series_name", "file_ord", "file_name", F.col("s.field").alias("field"), "pos")
    both = cells.withColumn("starts", F.lit(2)).withColumn("canonical", F.lit(None).cast("string")).unionByName(
        events.withColumn("file_name", F.lit(None).cast("string")).withColumn("pos", F.lit(None).cast("int"))
    )
    upto = Window.partitionBy("series_name", "field").orderBy("file_ord", "starts")
    last = F.last(F.when(F.col("starts") < 2, F.struct("canonical")), ignorenulls=True).over(upto)["canonical"]
    fed = both.withColumn("canonical", F.coalesce(last, "field")).where("file_name IS NOT NULL")
    placed = fed.groupBy("series_name", "file_name").agg(F.array_sort(F.collect_list(F.struct("pos", "canonical"))).alias("f"))
    return placed.select("series_name", "file_name", F.transform("f", lambda x: x["canonical"]).alias("feeds"))


def consistent_table(lines: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """All files as one table: series_name, file_name, line_no, a typed column per entry of ``columns``, misfits, others.

    ``columns`` maps output names to (canonical field, SQL type). Each file's script compiles to the positions that feed each
    column, so a record is projected as it is read and never taken apart into rows. An array column holds the record's
    filled values in their order, packed cells split, so that a field that is repeated in one file and packed in
    another looks the same; a single column holds the first value. A value the type can't hold is null there
    and stands in ``misfits`` (map of column and values); ``others`` is a map of the remaining fields. Records without any filled cell keep
    their row; a record that is there twice has two.
    """
    files = keep(read_files(lines), "files")
    feeds = keep(projections(files, edit_scripts(files, rename_evidence(lines, files))), "feeds")
    rows = lines.where("line_no > 0").join(feeds, ["series_name", "file_name"], "left")
    parts = lambda v: F.filter(F.transform(F.split(F.coalesce(v, F.lit("")), r"[;|]"), lambda x: strip(x)), lambda x: x != "")
    cells = F.filter(
        F.zip_with(F.coalesce("feeds", F.array().cast("array<string>")), split_record(F.col("raw_line")), lambda c, v: F.struct(c.alias("k"), parts(v).alias("v"))),
        lambda e: F.coalesce((e["k"] != "") & (F.size(e["v"]) > 0), F.lit(False)),
    )

    def typed(own: Column, sql_type: str) -> Column:
        """(value, what doesn't fit) of a column's values."""
        if sql_type.startswith("array<"):
            kind = sql_type[6:-1]
            value = F.when(F.size(own) > 0, F.array_compact(F.transform(own, lambda v: v.try_cast(kind))))
            return F.struct(value.alias("value"), F.filter(own, lambda v: v.try_cast(kind).isNull()).alias("bad"))
        first = F.get(own, F.lit(0))
        value = first.try_cast(sql_type)
        if sql_type in ("int", "bigint"):  # a whole number may stand as 3.0 in a file where the column became decimal
            value = F.coalesce(value, first.try_cast("decimal(38,6)").try_cast(sql_type))
        return F.struct(value.alias("value"), F.when(value.isNull() & first.isNotNull(), F.array(first)).otherwise(F.array().cast("array<string>")).alias("bad"))

    wanted = [f for f, _ in columns.values()]

    def projected(filled: Column) -> Column:
        of = lambda canonical: F.flatten(F.transform(F.filter(filled, lambda e: e["k"] == canonical), lambda e: e["v"]))
        rest = F.filter(filled, lambda e: ~e["k"].isin(wanted))
        others = F.transform(F.array_distinct(F.transform(rest, lambda e: e["k"])), lambda k: F.struct(k.alias("k"), F.flatten(F.transform(F.filter(rest, lambda e: e["k"] == k), lambda e: e["v"])).alias("v")))
        return F.struct(*[typed(of(f), sql_type).alias(n) for n, (f, sql_type) in columns.items()], others.alias("_others"))

    wide = rows.select("series_name", "file_name", "line_no", let(cells, projected).alias("_p"))
    misfits = F.filter(F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"_p.{n}.bad").alias("values")) for n in columns]), lambda m: F.size(m["values"]) > 0)
    return wide.select(
        "series_name", "file_name", "line_no", *[F.col(f"_p.{n}.value").alias(n) for n in columns], F.map_from_entries(misfits).alias("misfits"), F.map_from_entries("_p._others").alias("others")
    )


# --- nested DataFrames -----------------------------------------------------------------------------------------------

#: Types from narrow to wide; two types meet in the wider one, types of different families in text.
_WIDER = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType())


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type both can be read as."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WIDER and b in _WIDER:
        wide = _WIDER[max(_WIDER.index(a), _WIDER.index(b))]
        return T.DoubleType() if wide == T.FloatType() and T.LongType() in (a, b) else wide
    return T.StringType()


def compile_select(frame: DataFrame, script: Sequence[Step], target: Sequence[tuple[str, T.DataType]]) -> DataFrame:
    """One ``select`` that brings a frame of the old schema into the target's paths and types.

    ``target`` lists (path, type) of all fields in order; fields that the script adds are null, whole structs are rebuilt.
    """
    origin = {s.after: s.before for s in script if s.is_field and s.op in ("rename", "move")}
    have = {n.path for n in struct_tree(frame.schema).walk() if n.is_field} - set(origin.values())
    quoted = lambda path: ".".join(f"`{p}`" for p in path.split("."))

    def leaf(path: str, kind: T.DataType) -> Column:
        source = origin.get(path, path if path in have else None)
        value = F.lit(None) if source is None else F.col(quoted(source))
        simple = not isinstance(kind, (T.ArrayType, T.MapType))
        return (value.try_cast(kind) if simple else value.cast(kind)).alias(path.rpartition(".")[2])

    def level(prefix: str) -> list[Column]:
        out, seen = [], set()
        for path, kind in target:
            if path.startswith(prefix):
                head, _, rest = path[len(prefix) :].partition(".")
                if not rest:
                    out.append(leaf(path, kind))
                elif head not in seen:
                    seen.add(head)
                    out.append(F.struct(*level(prefix + head + ".")).alias(head))
        return out

    return frame.select(*level(""))


def consistent_frames(frames: Sequence[DataFrame], renamed: Sequence[Mapping[tuple[str, str], float]] = ()) -> tuple[DataFrame, list[list[Step]]]:
    """Frames with drifting nested schemas, oldest first, as one table in the newest names, and the script of each step.

    ``renamed`` may give, per step, the share of values that live on by (path before, path after). Fields that were
    deleted stay, null in later frames; types meet in the common type. Field names must not hold a dot.
    """
    kinds = lambda f: {n.path: _type_at(f.schema, n.path) for n in struct_tree(f.schema).walk() if n.is_field}
    scripts = []
    for i, (a, b) in enumerate(zip(frames, frames[1:])):
        text = [{p: k.simpleString() for p, k in kinds(f).items()} for f in (a, b)]
        scripts.append(edit_script(struct_tree(a.schema), struct_tree(b.schema), renamed[i] if i < len(renamed) else {}, *text, trust_labels=True))
    target: dict[str, T.DataType] = {}
    sources: list[dict[str, str]] = []
    for i, f in enumerate(frames):
        if i:
            moved = {s.before: s.after for s in scripts[i - 1] if s.is_field and s.op in ("rename", "move")}
            merged: dict[str, T.DataType] = {}
            for p, k in target.items():
                q = moved.get(p, p)
                merged[q] = common_type(merged[q], k) if q in merged else k
            target, sources = merged, [{moved.get(p, p): o for p, o in s.items()} for s in sources]
        sources.append({p: p for p in kinds(f)})
        for p, k in kinds(f).items():
            target[p] = common_type(target[p], k) if p in target else k
    # a path that is a field in one frame and a struct in another can't be both in one table
    inner = {p[:i] for p in target for i in range(len(p)) if p[i] == "."}
    listed = [(p, k) for p, k in target.items() if p not in inner]
    parts = [compile_select(f, [Step("rename", o, p) for p, o in s.items() if o != p], listed) for f, s in zip(frames, sources)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, scripts


def _type_at(schema: T.StructType, path: str) -> T.DataType:
    at: T.DataType = schema
    for part in path.split("."):
        at = at[part].dataType
    return at
