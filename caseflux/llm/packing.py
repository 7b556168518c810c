"""Problem 7: documents into containers of fixed capacity, by bin completion.

Sizes are tokens of a public tokenizer.  A document longer than a container is
cut into full pieces and a rest; nothing else is cut.  Pieces are spread over
shards of a bounded number of items; each shard is packed by itself, so a
shard's only loss is its last container.
"""

from __future__ import annotations

import base64
import bisect
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflux.session import Workspace

CAPACITY = 2048
MOST_PARTITIONS = 10_000
SHARD_ITEMS = 4096
#: Search steps of the branch-and-bound in a shard; the incumbent stands when they are spent.
NODES = 200_000
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the byte-level tokenizer splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _counter(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer(SparkFiles.get(name)).encode_ordinary
        for b in batches:
            n = [len(count(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["doc_id", "tokens"])

    return run


def token_counts(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, tokens) of every document with a text; each row is one item.

    The vocabulary file at ``path`` is needed by the driver alone, which hands it to the executors.
    """
    documents.sparkSession.sparkContext.addFile(path)
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    return read.mapInArrow(_counter(os.path.basename(path)), "doc_id long, tokens long")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: the incumbent.  Containers as lists of indices."""
    room: list[tuple[int, int]] = []  # (free, container), ordered
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect.bisect_left(room, (sizes[i], -1))
        if at == len(room):
            bins.append([i])
            bisect.insort(room, (capacity - sizes[i], len(bins) - 1))
        else:
            free, k = room.pop(at)
            bins[k].append(i)
            bisect.insort(room, (free - sizes[i], k))
    return bins


def _completions(counts: dict[int, int], order: list[int], free: int, low: int, high: int, budget: list[int]) -> Iterator[tuple[int, ...]]:
    """Undominated fillings of ``free`` that waste ``low`` to ``high``, one at a time.

    ``order`` has the sizes left, largest first.  A filling is dominated if
    another size fits beside it, or if one of its sizes could be exchanged for
    a larger one that is left.  Nothing but the budget ends the enumeration.
    """
    rising = order[::-1]
    used: dict[int, int] = {}

    def has(s: int) -> bool:
        return counts[s] > used.get(s, 0)

    def dominated(left: int) -> bool:
        if not left:
            return False
        if any(has(s) for s in rising[: bisect.bisect_right(rising, left)]):
            return True
        return any(has(o) for s in set(taken) for o in rising[bisect.bisect_right(rising, s) : bisect.bisect_right(rising, s + left)])

    taken: list[int] = []
    at, left = 0, free
    while budget[0] > 0:
        budget[0] -= 1
        k = max(at, len(order) - bisect.bisect_right(rising, left))
        while k < len(order) and not has(order[k]):
            k += 1
        if k < len(order):
            s = order[k]
            taken.append(s)
            used[s] = used.get(s, 0) + 1
            left -= s
            at = k
            continue
        if low <= left <= high and not dominated(left):
            yield tuple(taken)
        if not taken:
            return
        s = taken.pop()
        used[s] -= 1
        left += s
        at = len(order) - bisect.bisect_left(rising, s)


def _fillings(counts: dict[int, int], free: int, waste: int, budget: list[int]) -> Iterator[tuple[int, ...]]:
    """Fillings without waste first, then those that waste up to ``waste``."""
    order = sorted((s for s, c in counts.items() if c > 0), reverse=True)
    yield from _completions(counts, order, free, 0, 0, budget)
    if waste > 0:
        yield from _completions(counts, order, free, 1, waste, budget)


def bin_completion(sizes: list[int], capacity: int = CAPACITY, nodes: int = NODES) -> list[list[int]]:
    """Containers (lists of indices) of the sizes, each at most ``capacity``.

    Depth-first: the largest item left opens a container, undominated fillings
    complete it.  A branch is cut when the waste so far leaves no better result
    than the incumbent, which starts as best-fit decreasing.  If the search
    ends before ``nodes`` steps are spent, no packing has fewer containers.
    Empty items take no room and lie in the first container.
    """
    some = [i for i, s in enumerate(sizes) if s > 0]
    if len(some) < len(sizes):
        packed = [[some[k] for k in items] for items in bin_completion([sizes[i] for i in some], capacity, nodes)] or [[]]
        packed[0] += [i for i, s in enumerate(sizes) if s <= 0]
        return packed
    best = best_fit(sizes, capacity)
    total = sum(sizes)
    bound = -(-total // capacity)
    if len(best) <= bound:
        return best
    counts: dict[int, int] = {}
    for s in sizes:
        counts[s] = counts.get(s, 0) + 1
    budget = [nodes]
    goal, rest = len(best), len(sizes)
    answer: list[tuple[int, ...]] | None = None
    chosen: list[tuple[int, ...]] = []
    # each open container: its largest item, the fillings still to try, the waste before it
    stack: list[tuple[int, Iterator[tuple[int, ...]], int]] = []

    def open_container(waste: int) -> None:
        big = max(s for s, c in counts.items() if c > 0)
        counts[big] -= 1
        stack.append((big, _fillings(counts, capacity - big, (goal - 1) * capacity - total - waste, budget), waste))

    open_container(0)
    while stack and budget[0] > 0 and goal > bound:
        big, fillings, waste = stack[-1]
        if len(chosen) == len(stack):  # take back the filling tried last
            last = chosen.pop()
            rest += len(last)
            for s in last[1:]:
                counts[s] += 1
        filling = next(fillings, None) if (goal - 1) * capacity - total - waste >= 0 else None
        if filling is None:
            counts[big] += 1
            stack.pop()
            continue
        for s in filling:
            counts[s] -= 1
        chosen.append((big, *filling))
        rest -= len(filling) + 1
        if not rest:
            if len(chosen) < goal:
                goal, answer = len(chosen), list(chosen)
            continue
        waste += capacity - big - sum(filling)
        if (goal - 1) * capacity - total - waste >= 0:
            open_container(waste)
    if answer is None:
        return best
    by_size: dict[int, list[int]] = {}
    for i in range(len(sizes) - 1, -1, -1):
        by_size.setdefault(sizes[i], []).append(i)
    return [[by_size[s].pop() for s in filling] for filling in answer]


def _pack(capacity: int):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["tokens", "doc_id", "piece"], ascending=[False, True, True]).reset_index(drop=True)
        container = [0] * len(shard)
        for k, items in enumerate(bin_completion(shard["tokens"].tolist(), capacity)):
            for i in items:
                container[i] = k
        shard["container"] = container
        return shard[["doc_id", "piece", "first_token", "tokens", "shard", "container"]]

    return run


def pack_documents(documents: DataFrame, work: Workspace, capacity: int = CAPACITY, path: str = TOKENIZER, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """(doc_id, piece, first_token, tokens, container_id): the container of each piece.

    Documents of at most ``capacity``
    tokens are piece 0; longer ones have full pieces and a rest.  Null texts
    are in no container, empty ones take no room but have a place; repeated
    rows are items of their own; an empty table gives no row.
    """
    counted = work.save(token_counts(documents, path), "token_counts")
    # rows of one id and length differ by their number alone, so the shards do not depend on the partitioning
    copies = counted.groupBy("doc_id", "tokens").agg(F.count("*").alias("c"))
    counted = copies.select("doc_id", "tokens", F.explode(F.sequence(F.lit(1), F.col("c").cast("int"))).alias("copy"))
    pieces = counted.select("doc_id", "copy", "tokens", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("tokens") / capacity).cast("int") - 1, F.lit(0)))).alias("piece"))
    pieces = pieces.select("doc_id", "copy", "piece", (F.col("piece") * capacity).cast("long").alias("first_token"), F.least(F.col("tokens") - F.col("piece") * capacity, F.lit(capacity)).cast("long").alias("tokens"))
    open_pieces = pieces.where(F.col("tokens") < capacity)
    n = open_pieces.count()
    shards = max(1, -(-n // shard_items))
    # rows of one id spread by their number too, so no id can fill a shard
    spread = open_pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "copy", "piece", "tokens"), F.lit(shards)).cast("int"))
    schema = "doc_id long, piece int, first_token long, tokens long, shard int, container int"
    # a shard is minutes of search in few bytes: a partition count of its own keeps shards from being coalesced
    packed = spread.drop("copy").repartition(min(shards, MOST_PARTITIONS), "shard").groupBy("shard").applyInPandas(_pack(capacity), schema)
    packed = packed.withColumn("container_id", F.concat_ws("-", F.lit("s"), "shard", "container")).drop("shard", "container")
    # full pieces are containers of their own
    full = pieces.where(F.col("tokens") == capacity).withColumn("container_id", F.concat_ws("-", F.lit("d"), "doc_id", "piece", "copy")).drop("copy")
    return packed.unionByName(full)
