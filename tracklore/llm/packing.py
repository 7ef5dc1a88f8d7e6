"""Filling fixed-capacity containers with documents: bulk-synchronous best fit.

Documents and gaps are whole numbers of tokens up to the capacity, so sorting both
by range gives one class per number. A superstep takes the largest class of
documents that are left and sweeps the classes of gaps from its size upwards (the
successor): as many documents as the tightest gaps can take are matched at once,
conflicts are resolved by rank within the class, the gaps move to their new class,
and the next superstep begins; what no gap takes opens new containers. The result
is that of best-fit decreasing. The state of a sweep is runs of documents of one
size against runs of containers of one gap, so its size depends on the capacity
and not on the corpus; documents meet their run in a join, never on the driver.

Only a document longer than a container is split, into full pieces and a rest.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections import defaultdict, deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklore.session import cut, spread

#: Tokens of a container.
CAPACITY = 2048
#: Name of the vocabulary file of the tokenizer, looked up in the installed collection unless a path is given.
TOKENIZER = "byte_bpe_50k.tiktoken"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def token_counts(docs: DataFrame, doc_id: str, text: str, path: str | None = None) -> DataFrame:
    """(doc_id, tokens) of a byte-level BPE given by its file of ranks; 0 for null and empty texts."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for pdf in batches:
            n = [len(encoding.encode_ordinary(t)) if t else 0 for t in pdf["t"]]
            yield pd.DataFrame({doc_id: pdf["d"], "tokens": n})

    rows = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).where(F.col("d").isNotNull())
    return spread(rows).mapInPandas(run, f"{doc_id} long, tokens long")


def plan(sizes: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Best-fit decreasing over classes: runs (size, first rank, count, first container).

    A document of ``size`` and rank ``first rank + i`` goes to container ``first
    container + i``. Sizes are between 1 and the capacity.
    """
    runs: list[tuple[int, int, int, int]] = []
    gaps: dict[int, deque[tuple[int, int]]] = defaultdict(deque)  # gap -> runs (first container, count)
    order: list[int] = []  # gaps that have containers
    opened = 0

    def free(gap: int, first: int, count: int) -> None:
        if gap > 0 and count:
            if not gaps[gap]:
                insort(order, gap)
            gaps[gap].append((first, count))

    for size in sorted(sizes, reverse=True):
        rank, left = 0, sizes[size]
        while left and (at := bisect_left(order, size)) < len(order):
            gap = order[at]
            first, count = gaps[gap].popleft()
            take = min(left, count)
            if take < count:
                gaps[gap].appendleft((first + take, count - take))
            elif not gaps[gap]:
                order.pop(at)
            runs.append((size, rank, take, first))
            free(gap - size, first, take)
            rank, left = rank + take, left - take
        each = capacity // size
        full, rest = divmod(left, each)
        for _ in range(each if full else 0):
            runs.append((size, rank, full, opened))
            rank += full
        free(capacity - each * size, opened, full)
        opened += full
        for _ in range(rest):
            runs.append((size, rank, 1, opened))
            rank += 1
        if rest:
            free(capacity - rest * size, opened, 1)
            opened += 1
    return runs


def _ranked(items: DataFrame) -> DataFrame:
    """Rank of each item within its size from 0, without bringing a size together.

    Items are numbered within the partitions of a written table; what the partitions
    before hold of a size is added, from a table of partitions by sizes.
    """
    items = cut(items.withColumn("pid", F.spark_partition_id()))
    before = items.groupBy("size", "pid").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("size").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("size", "pid", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("size", "pid").orderBy("doc_id", "part")) - 1
    return items.withColumn("k", within).join(before, ["size", "pid"]).select("doc_id", "part", "size", (F.col("k") + F.col("offset")).alias("rank"))


def pack(counts: DataFrame, doc_id: str = "doc_id", tokens: str = "tokens", capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, part, tokens, container_id): every document's tokens in a container.

    ``part`` is 0 but for a document longer than the capacity, which has a row for each
    full piece and one for the rest. Documents without tokens, and null ids, are in no
    container. Each row counts, repeated ones too. An empty table gives an empty result.
    """
    if capacity < 1:
        raise ValueError("a container holds at least one token")
    c = F.lit(capacity)
    items = counts.select(F.col(doc_id).alias("doc_id"), F.col(tokens).alias("n")).where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    items = items.withColumn("part", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / c).cast("int") - 1)))
    items = items.select("doc_id", "part", F.least(c, F.col("n") - F.col("part") * c).cast("int").alias("size"))
    ranked = cut(_ranked(items))
    sizes = {int(r[0]): int(r[1]) for r in ranked.groupBy("size").agg(F.count(F.lit(1))).collect()}  # at most ``capacity`` rows
    runs = counts.sparkSession.createDataFrame(plan(sizes, capacity), "size int, first long, count long, container long")
    # the runs of a size do not overlap; blocks of ranks make the search for a run an equi-join
    runs = runs.withColumn("block", F.explode(F.sequence(F.shiftright("first", _BLOCK), F.shiftright(F.col("first") + F.col("count") - 1, _BLOCK))))
    hit = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("count"))
    placed = ranked.withColumn("block", F.shiftright("rank", _BLOCK)).join(runs, ["size", "block"]).where(hit)
    return placed.select(F.col("doc_id").alias(doc_id), "part", F.col("size").alias("tokens"), (F.col("container") + F.col("rank") - F.col("first")).alias("container_id"))


#: Ranks of a block, as a power of two.
_BLOCK = 8


def packing_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, tokens, the least possible number of containers, fullest container, share of waste."""
    by = packed.groupBy("container_id").agg(F.sum("tokens").alias("used"))
    total = by.agg(F.count(F.lit(1)).alias("containers"), F.coalesce(F.sum("used"), F.lit(0)).alias("tokens"), F.coalesce(F.max("used"), F.lit(0)).alias("fullest"))
    least = F.ceil(F.col("tokens") / capacity)
    waste = F.when(F.col("containers") > 0, 1 - F.col("tokens") / (F.col("containers") * capacity)).otherwise(0.0)
    return total.select("containers", "tokens", "fullest", least.alias("least_containers"), F.round(waste, 6).alias("waste"))
