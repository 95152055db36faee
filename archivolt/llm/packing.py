"""Filling fixed-capacity containers with items, in bounded space.

Each partition packs its own items in one pass: a fixed number of containers stays open, an item goes into the open
one that it fills best, and where it fits none the fullest is closed and a new one opened. What stays open at the end
of the partitions is merged in rounds: the items of several partitions' open containers are packed anew, largest first,
full containers leave, at most the same fixed number stays open. Only ids and sizes move, never texts.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.session import cut

#: Pattern that splits text before byte-pair encoding, fixed with the vocabulary file.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"

OPEN = 64
#: Share of a container from which a merge closes it, and open lists merged by one task.
FULL, FAN_IN = 0.97, 16


def tokenizer(path: str):
    """Encoder from a file of ranks of a public byte-level vocabulary."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Packer:
    """Open containers of one capacity. Places are (item, part, start, size)."""

    def __init__(self, capacity: int, most_open: int = OPEN):
        self.capacity, self.most_open = capacity, most_open
        self.free: list[tuple[int, int]] = []  # (free space, container), sorted
        self.content: dict[int, list[tuple]] = {}
        self.made = 0

    def _new(self) -> int:
        self.made += 1
        self.content[self.made] = []
        return self.made

    def add(self, place: tuple) -> Iterator[tuple[int, list[tuple]]]:
        """Places an item no larger than the capacity; yields a container that had to close."""
        size = place[-1]
        at = bisect_left(self.free, (size, -1))
        if at < len(self.free):
            room, container = self.free.pop(at)
        else:
            if len(self.free) >= self.most_open:
                _, closed = self.free.pop(0)
                yield closed, self.content.pop(closed)
            room, container = self.capacity, self._new()
        self.content[container].append(place)
        if room > size:
            insort(self.free, (room - size, container))
        else:
            yield container, self.content.pop(container)

    def leftovers(self) -> list[tuple[int, int, list[tuple]]]:
        """(free space, container, content) of what is still open, fullest first."""
        return [(room, c, self.content[c]) for room, c in self.free]


def parts(item, size: int, capacity: int) -> Iterator[tuple]:
    """An item as it is placed: whole, or cut at the capacity where it is larger."""
    for n, start in enumerate(range(0, size, capacity)):
        yield (item, n, start, min(capacity, size - start))


_SCHEMA = "kind string, container string, capacity int, open boolean, item long, part int, start int, size int"
_COLUMNS = ["kind", "container", "capacity", "open", "item", "part", "start", "size"]


def _rows(kind: str, name: str, capacity: int, is_open: bool, content: Iterable[tuple]) -> list[tuple]:
    return [(kind, name, capacity, is_open, *place) for place in content]


def count_tokens(documents: DataFrame, doc_id: str, text: str, path: str = TOKENIZER) -> DataFrame:
    """(item, size): tokens of every text; null and empty texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokenizer(path).encode_ordinary
        for b in batches:
            yield pd.DataFrame({"item": b.item, "size": [len(encode(t)) if t else 0 for t in b.text]})

    return documents.select(F.col(doc_id).cast("long").alias("item"), F.col(text).alias("text")).mapInPandas(run, "item long, size int")


def _merger(turn: int, last: bool, most_open: int):
    """Packs the items of several partitions' open containers anew, largest first."""

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        kind, group = key
        capacity = int(rows.capacity.iloc[0])
        rows = rows.sort_values(["size", "item", "part"], ascending=[False, True, True])
        packer = Packer(capacity, len(rows) + 1)
        out: list[tuple] = []
        name = lambda c: f"{kind}-{turn}-{group}-{c}"
        for place in zip(rows["item"], rows["part"], rows["start"], rows["size"]):
            for container, content in packer.add(place):
                out += _rows(kind, name(container), capacity, False, content)
        open_now = packer.leftovers()
        for n, (room, container, content) in enumerate(open_now):
            # the emptiest stay open for the next round, at most as many as a partition keeps
            keep = not last and room > capacity * (1 - FULL) and n >= len(open_now) - most_open
            out += _rows(kind, name(container), capacity, keep, content)
        return pd.DataFrame(out, columns=_COLUMNS).assign(task=group)

    return merge


def pack(sizes: DataFrame, capacities: dict[str, int], most_open: int = OPEN) -> DataFrame:
    """Containers for items of (item, size): container_kind, container_id, item, part, start, size.

    For each kind of container all items are packed. An item larger than the capacity is cut into parts of the
    capacity and a rest; no other item is cut. Items without content need no container and have no row. Container
    ids are unique; repeated item ids are packed once per row.
    """
    kinds = sorted(capacities.items())

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        packers = [(kind, capacity, Packer(capacity, most_open)) for kind, capacity in kinds]
        for b in batches:
            rows: list[tuple] = []
            for item, size in zip(b["item"], b["size"]):
                for kind, capacity, packer in packers:
                    for place in parts(item, size, capacity):
                        for container, content in packer.add(place):
                            rows += _rows(kind, f"{kind}-0-{task}-{container}", capacity, False, content)
            yield pd.DataFrame(rows, columns=_COLUMNS)
        for kind, capacity, packer in packers:
            for _, container, content in packer.leftovers():
                yield pd.DataFrame(_rows(kind, f"{kind}-0-{task}-{container}", capacity, True, content), columns=_COLUMNS)

    packed = cut(sizes.mapInPandas(first, _SCHEMA).withColumn("task", F.spark_partition_id()))
    done, left = [packed.where("NOT open").drop("task")], packed.where("open")
    groups, turn = packed.rdd.getNumPartitions(), 0
    while groups > 1:
        groups, turn = -(-groups // FAN_IN), turn + 1
        merged = cut(
            left.withColumn("group", F.floor(F.col("task") / FAN_IN).cast("int"))
            .groupBy("kind", "group")
            .applyInPandas(_merger(turn, groups == 1, most_open), _SCHEMA + ", task int")
        )
        done.append(merged.where("NOT open").drop("task"))
        left = merged.where("open")
    done.append(left.drop("task"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(F.col("kind").alias("container_kind"), F.col("container").alias("container_id"), "item", "part", "start", "size")


def pack_texts(documents: DataFrame, spec: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """Texts packed into the containers of a specification (container_kind, capacity_tokens; a handful of rows).

    Columns: container_kind, container_id, doc_id, part, start_token, n_tokens.
    """
    rows = spec.select("container_kind", "capacity_tokens").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("more than 1000 kinds of container")
    packed = pack(count_tokens(documents, doc_id, text, path), {r[0]: int(r[1]) for r in rows})
    return packed.select(
        "container_kind", "container_id", F.col("item").alias("doc_id"), "part", F.col("start").alias("start_token"), F.col("size").alias("n_tokens")
    )
