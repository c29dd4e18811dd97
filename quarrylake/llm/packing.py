"""Filling containers of fixed capacity with items of varying size, over any number of items."""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Attention cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / 2048


def spread(left: dict[int, int], capacity: int, containers: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Places for items of given sizes (size -> count) and the containers used, opened beyond `containers` if need be.

    A place is (size, first rank, count, first container): items of that size with ranks from the first on lie in as many
    containers from the first on. Sizes go from the largest to the smallest, each item to the container of least cost that
    still has room for it. Containers with the same content are a range that is moved as one, so the work follows the number
    of different sizes and contents and not that of items. Within a room, ranges are ordered by cost in a heap.
    """
    places: list[tuple[int, int, int, int]] = []
    # (cost, start, end) of ranges of containers by the room left in them
    by_room: dict[int, list[tuple[float, int, int]]] = defaultdict(list)
    by_room[capacity] = [(0.0, 0, containers)]
    total = containers
    for size in sorted(left, reverse=True):
        count, rank = left[size], 0
        cost = LINEAR * size + QUADRATIC * size * size
        heap = [(by_room[room][0], room) for room in by_room if room >= size and by_room[room]]
        heapq.heapify(heap)
        while rank < count:
            if not heap:  # nothing has room: as many new ones as the rest needs
                add = -(-(count - rank) // (capacity // size))
                heapq.heappush(by_room[capacity], (0.0, total, total + add))
                total += add
                heap.append((by_room[capacity][0], capacity))
            least, room = heapq.heappop(heap)
            ranges = by_room[room]
            if not ranges or ranges[0] != least:
                continue  # stale: the room's least range is another by now, and was pushed when it became so
            own, start, end = heapq.heappop(ranges)
            n = min(end - start, count - rank)
            places.append((size, rank, n, start))
            rank += n
            if start + n < end:
                heapq.heappush(ranges, (own, start + n, end))
            if ranges:
                heapq.heappush(heap, (ranges[0], room))
            rest = room - size
            moved = (own + cost, start, start + n)
            heapq.heappush(by_room[rest], moved)
            if rest >= size and by_room[rest][0] == moved:
                heapq.heappush(heap, (moved, rest))
    return places, total


def packed(sizes: DataFrame, key: str, size: str, capacity: int, rows_a_part: int = 250_000) -> DataFrame:
    """(key, piece, first, n, container_id): the container of each item, or of each piece of one beyond the capacity.

    An item beyond the capacity is cut into pieces of the capacity and a rest; all others stay whole. Items of size null or
    below 1 need no place. Only the counts by size (at most `capacity` of them) reach the driver, which fits all items into
    ceil(total / capacity) containers by `spread` (opening more only if some fit nowhere); the items are then numbered within
    their size, those of a frequent size in parts side by side, and the number tells the place. Equal keys are told apart by
    nothing: repeated rows each get a place. Extra columns of `sizes` are not read. An empty table needs no container.
    """
    spark = sizes.sparkSession
    whole = sizes.select(F.col(key), F.col(size).cast("bigint").alias("__size")).filter("__size > 0")
    last = F.expr(f"(__size - 1) div {capacity}").cast("int")
    items = whole.select(key, "__size", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    items = items.select(key, "piece", (F.col("piece").cast("bigint") * capacity).alias("first"), F.least(F.lit(capacity), F.col("__size") - F.col("piece").cast("bigint") * capacity).cast("int").alias("n"))
    counts = {r["n"]: r["count"] for r in items.groupBy("n").count().collect()}
    total = sum(n * c for n, c in counts.items())
    places, _ = spread(counts, capacity, -(-total // capacity))
    parts = max(1, -(-max(counts.values(), default=0) // rows_a_part))
    items = items.withColumn("__part", F.pmod(F.xxhash64(key, "piece"), F.lit(parts)).cast("int"))
    before = items.groupBy("n", "__part").agg(F.count(F.lit(1)).alias("__c"))
    before = before.withColumn("__before", F.sum("__c").over(Window.partitionBy("n").orderBy("__part")) - F.col("__c")).drop("__c")
    local = F.row_number().over(Window.partitionBy("n", "__part").orderBy(key, "piece"))
    ranked = items.withColumn("__local", local).join(before, ["n", "__part"])
    ranked = ranked.select(key, "piece", "first", "n", (F.col("__before") + F.col("__local") - 1).alias("__rank"))
    table = np.array(sorted(places), np.int64).reshape(-1, 4)
    # one row for each move of a range: the work of `spread`, which does not grow with the number of items
    moves = spark.sparkContext.broadcast((table[:, 0] << 44 | table[:, 1], table[:, 3] - table[:, 1]))

    def place(batches):
        starts, shift = moves.value
        for pdf in batches:
            at = np.searchsorted(starts, pdf["n"].to_numpy(np.int64) << 44 | pdf["__rank"].to_numpy(np.int64), "right") - 1
            pdf["container_id"] = pdf["__rank"].to_numpy(np.int64) + shift[at] if len(pdf) else pd.Series([], dtype="int64")
            yield pdf[[key, "piece", "first", "n", "container_id"]]

    return ranked.mapInPandas(place, f"`{key}` {sizes.schema[key].dataType.simpleString()}, piece int, first bigint, n int, container_id bigint")
