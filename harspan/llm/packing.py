"""Filling fixed-capacity containers with items.

Method: harmonic packing. A length belongs to the class of the largest k with k such items in a container; the
containers of class k take exactly k items each. Every worker fills the containers of its own partition without any
exchange, so nothing is shuffled. The space that a container of the larger classes leaves takes items of the smaller
ones of the same worker, and items smaller than the last class are filled by size. Unfinished containers, fewer items than there are classes times
their counts for each worker, are filled up in ever fewer workers, the very last of them in one.

A text longer than the capacity is cut into full containers and a rest, which is packed as an item; no other text is
cut.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .tokens import TOKENIZER_DIR, TOKENIZER_FILE, token_count

#: Lengths below capacity / CLASSES are filled by size instead of by count.
CLASSES = 12
#: Items that a worker holds at once; a window is packed before the next is read.
WINDOW = 20_000
#: Workers whose unfinished containers meet in one worker of the next round.
GATHER = 32
_ITEM = "doc_id bigint, piece_no int, n_tokens int, container_id string"


def document_sizes(df: DataFrame, id_column: str, text_column: str, directory: str = TOKENIZER_DIR, file: str = TOKENIZER_FILE) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every row; a null or empty text has 0 tokens."""
    return df.select(F.col(f"`{id_column}`").alias("doc_id"), token_count(F.col(f"`{text_column}`").cast("string"), directory, file).alias("n_tokens"))


def cut_long(sizes: DataFrame, capacity: int) -> DataFrame:
    """``doc_id``, ``piece_no`` from 0 and ``n_tokens``: one piece for what fits, else full pieces and the rest."""
    last = F.greatest(F.ceil(F.col("n_tokens") / capacity) - 1, F.lit(0)).cast("int")
    return sizes.select("doc_id", "n_tokens", F.posexplode(F.sequence(F.lit(0), last)).alias("piece_no", "at")).select(
        "doc_id", "piece_no", F.least(F.lit(capacity), F.col("n_tokens") - F.col("piece_no") * capacity).cast("int").alias("n_tokens")
    )


def fill_classes(items: list[tuple], capacity: int, classes: int, label: str, finish: bool) -> tuple[list[tuple], list[tuple]]:
    """Harmonic packing of ``items`` (id, piece, size): the packed ones with their container, and those left over.

    Containers are opened by the largest items, each with as many of one class as it counts; the space that they leave
    goes to the largest items of later classes that fit. Items of a class too few for a container are left over, unless
    ``finish`` has them completed with whatever fits.
    """
    order = sorted(items, key=lambda item: item[2])
    sizes = [item[2] for item in order]
    packed: list[tuple] = []
    left: list[tuple] = []
    n = 0
    while order:
        k = min(capacity // sizes[-1], classes + 1) if sizes[-1] else classes + 1
        count = k if k <= classes else 1
        if count > len(order) or (k <= classes and capacity // max(sizes[-count], 1) != k):
            if not finish:
                # fewer than a container takes: all of this class are left over
                while order and sizes[-1] and capacity // sizes[-1] == k:
                    left.append(order.pop())
                    sizes.pop()
                continue
            count = 1
        group = [order.pop() for _ in range(count)]
        space = capacity - sum(sizes.pop() for _ in range(count))
        while order and sizes[0] <= space:
            at = bisect_right(sizes, space) - 1
            group.append(order.pop(at))
            space -= sizes.pop(at)
        if k > classes and not order and not finish and len(group) < WINDOW // 2:
            left.extend(group)
            break
        name = f"{label}-{n}"
        n += 1
        packed.extend((*item, name) for item in group)
    return packed, left


def _pack_round(items: DataFrame, capacity: int, classes: int, round_no: int, finish: bool) -> DataFrame:
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        part, seq, held = context.partitionId() if context else 0, 0, []

        def rows(found: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(found, columns=["doc_id", "piece_no", "n_tokens", "container_id"])

        for batch in batches:
            held.extend(zip(batch["doc_id"].tolist(), batch["piece_no"].tolist(), batch["n_tokens"].tolist()))
            if len(held) >= WINDOW and not finish:
                done, held = fill_classes(held, capacity, classes, f"{round_no}-{part}-{seq}", False)
                seq += 1
                yield rows(done)
        done, held = fill_classes(held, capacity, classes, f"{round_no}-{part}-{seq}", finish)
        yield rows(done + [(*item, None) for item in held])

    return items.select("doc_id", "piece_no", "n_tokens").mapInPandas(pack, _ITEM)


def pack_documents(df: DataFrame, id_column: str, text_column: str, capacity: int, classes: int = CLASSES,
                   directory: str = TOKENIZER_DIR, file: str = TOKENIZER_FILE) -> DataFrame:
    """What lies in each container: ``container_id``, ``doc_id``, ``piece_no`` and ``n_tokens``.

    Every row of ``df`` is packed, repeated rows and null ids too; a null or empty text takes no space and lies in some
    container. An empty table gives an empty result. Two container ids are equal only for one container.
    """
    if capacity < 1:
        raise ValueError("a container holds at least one token")
    sizes = document_sizes(df, id_column, text_column, directory, file)
    pieces = cut_long(sizes, capacity)
    first = checkpointed(_pack_round(pieces, capacity, classes, 0, False))
    done = [first.where("container_id is not null")]
    # written apart, so that fewer workers need not read what is packed
    rest = checkpointed(first.where("container_id is null"))
    workers = first.rdd.getNumPartitions()
    round_no = 1
    while workers > GATHER:
        workers = -(-workers // GATHER)
        packed = checkpointed(_pack_round(rest.coalesce(workers), capacity, classes, round_no, False))
        done.append(packed.where("container_id is not null"))
        rest = checkpointed(packed.where("container_id is null"))
        round_no += 1
    # at most the unfinished containers of GATHER workers
    done.append(_pack_round(rest.coalesce(1), capacity, classes, round_no, True))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("container_id", "doc_id", "piece_no", "n_tokens")


def containers(contents: DataFrame, capacity: int) -> DataFrame:
    """One row per container: ``n_items``, ``used_tokens`` and ``unused_tokens``."""
    return contents.groupBy("container_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("n_tokens").alias("used_tokens"), (F.lit(capacity) - F.sum("n_tokens")).alias("unused_tokens")
    )
