"""From signatures to verified links, for joins whose matches share at least one of their signatures.

Signatures are packed by range into few rows before the shuffle. Of the nodes that share a signature, each is compared with
the smallest one, and only where a signature still joins different components are its other pairs compared, so a group
is never expanded into all its pairs while one component holds it, and yet no link between components is missed.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.llm.common import BROADCAST_ROWS, semi_join, stored
from clickfeat.llm.components import components

# Of the signatures packed at a time: nodes that share one are tied to one of them before the shuffle, from this count on.
HOT = 64
KEPT = 5  # bytes of a signature that are sent, next to its bucket
ROWS = 1 << 18  # signatures packed at a time, which bounds the memory of a task
PACKED = "bucket int, leaders binary, base long, signatures binary, nodes binary"


def _five_bytes(found: np.ndarray) -> bytes:
    return np.ascontiguousarray(found.view(np.uint8).reshape(-1, 8)[:, :KEPT]).tobytes()


def _from_five_bytes(raw: bytes, bucket: int) -> np.ndarray:
    out = np.zeros((len(raw) // KEPT, 8), np.uint8)
    out[:, :KEPT] = np.frombuffer(raw, np.uint8).reshape(-1, KEPT)
    return out.view(np.uint64).ravel() + np.uint64(bucket << (8 * KEPT))


def pack(found: np.ndarray, owner: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Signatures and their nodes (int64) as one row for each bucket of signatures, and one for what is hot here.

    A signature is shortened to its bucket and ``KEPT`` bytes. Two that then fall together only add candidates.
    """
    bucket = ((found >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    found = (bucket << np.uint64(8 * KEPT)) + (found & np.uint64((1 << 8 * KEPT) - 1))
    order = np.argsort(found, kind="stable")
    found, owner = found[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(found)))
    rows = []
    crowded = times >= HOT
    if crowded.any():
        hot = np.repeat(crowded, times)
        least = np.minimum.reduceat(owner, first)
        rows.append((int(found[hot][0] % np.uint64(buckets)), np.repeat(least[crowded], times[crowded]), found[hot], owner[hot]))
        keep = ~hot
        keep[first[crowded]] = True
        owner = np.where(hot, np.repeat(least, times), owner)[keep]
        found = found[keep]
    bucket = found >> np.uint64(8 * KEPT)
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(found) else []
    rows += [(int(bucket[i]), None, found[i:j], owner[i:j]) for i, j in itertools.pairwise(cuts)]
    base = int(owner.min()) if len(owner) else 0
    narrow = bool(len(owner)) and int(owner.max()) - base < 1 << 32

    def nodes(leaders: np.ndarray | None, values: np.ndarray) -> bytes:
        if narrow and leaders is None:
            return (values - base).astype(np.uint32).tobytes()
        return values.astype(np.int64).tobytes()

    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int32()),
            pa.array([None if r[1] is None else r[1].astype(np.int64).tobytes() for r in rows], pa.binary()),
            pa.array([base if narrow else None] * len(rows), pa.int64()),
            pa.array([r[2].tobytes() if r[1] is not None else _five_bytes(r[2]) for r in rows], pa.binary()),
            pa.array([nodes(r[1], r[3]) for r in rows], pa.binary()),
        ],
        ["bucket", "leaders", "base", "signatures", "nodes"],
    )


def packed(parts: Iterable[tuple[np.ndarray, np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    """``pack`` for signatures and nodes that come in parts, about ``ROWS`` at a time."""
    waiting, count = [], 0
    for part in parts:
        waiting.append(part)
        count += len(part[0])
        if count >= ROWS:
            yield pack(*(np.concatenate(x) for x in zip(*waiting)), buckets)
            waiting, count = [], 0
    if count:
        yield pack(*(np.concatenate(x) for x in zip(*waiting)), buckets)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    found, node = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((node, found))
    found, node = found[order], node[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (node[1:] != node[:-1])
    found, node = found[new], node[new]
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    times = np.diff(np.append(first, len(found)))
    several = np.repeat(times > 1, times)
    return _rows(found[several], np.repeat(node[first], times)[several], node[several])


def _rows(found: np.ndarray, leader: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(found.view(np.int64)), pa.array(leader), pa.array(node)], ["signature", "leader", "node"]
    )


def shared(rows: DataFrame) -> DataFrame:
    """(signature, leader, node) of every signature that several nodes share; the leader is the smallest of them, or the
    smallest of one batch for the nodes that were tied there. A task holds one bucket at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["leaders"] is not None:
                    found = np.frombuffer(row["signatures"], np.uint64)
                    yield _rows(found, np.frombuffer(row["leaders"], np.int64), np.frombuffer(row["nodes"], np.int64))
                    continue
                if row["bucket"] != bucket and parts:
                    yield _merged(parts)
                    parts = []
                bucket = row["bucket"]
                found = _from_five_bytes(row["signatures"], bucket)
                if row["base"] is None:
                    parts.append((found, np.frombuffer(row["nodes"], np.int64)))
                else:
                    parts.append((found, np.frombuffer(row["nodes"], np.uint32).astype(np.int64) + row["base"]))
        if parts:
            yield _merged(parts)

    in_order = rows.repartition("bucket").sortWithinPartitions("bucket")
    return in_order.mapInArrow(run, "signature long, leader long, node long")


def _labelled(rows: DataFrame, label: DataFrame, by: str, name: str, few: bool) -> DataFrame:
    """``rows`` plus the component of the node in column ``by``; a node without links is its own component."""
    side = label.select(F.col("node").alias("_of"), F.col("component").alias("_label"))
    joined = rows.join(F.broadcast(side) if few else side, F.col(by) == F.col("_of"), "left")
    return joined.withColumn(name, F.coalesce("_label", by)).drop("_of", "_label")


def resolve(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    facts: DataFrame,
    possible: Callable[[Column, Column], Column],
) -> DataFrame:
    """Links (a, b) that join the same components as all links between nodes that share a signature.

    ``members`` comes from ``shared``; ``verify`` keeps the pairs (a, b) that are links. ``facts`` has a small ``fact`` of
    every node, and ``possible`` says whether two nodes with given facts can be linked at all.
    """
    # In a signature, lead by the node that is in most signatures: among copies of one text that is the one most like it.
    counts = members.groupBy("node").agg(F.count(F.lit(1)).alias("_n"))
    heavy = members.select("signature", "leader", "node").join(counts, "node")
    best = F.max(F.struct("_n", (-F.col("node")).alias("_node")))
    leaders = heavy.groupBy("signature", "leader").agg(best.alias("_best"))
    leaders = leaders.select(
        "signature", "leader", F.col("_best._n").alias("_n"), (-F.col("_best._node")).alias("_lead")
    )
    members = members.join(leaders, ["signature", "leader"]).select("signature", F.col("_lead").alias("leader"), "node", "_n")
    members = stored(members, "led")
    # Each node against the leader in most signatures of those it has.
    pairs = members.groupBy("node").agg(F.max(F.struct("_n", (-F.col("leader")).alias("_l"))).alias("_best"))
    pairs = pairs.select("node", (-F.col("_best._l")).alias("a")).where(F.col("a") != F.col("node"))
    pairs = pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
    tested = stored(pairs, "pairs")
    links = stored(verify(tested), "links")
    for leaders_only in (True, False):
        label = stored(components(links), "components")
        few = label.count() <= BROADCAST_ROWS
        labelled = _labelled(_labelled(members, label, "node", "c", few), label, "leader", "leader_c", few)
        if leaders_only:
            # Against the leaders of all signatures that still join different components.
            apart = labelled.where(F.col("c") != F.col("leader_c"))
            pairs = apart.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b"))
        else:
            # Where a signature joins different components after that, over all its groups: everything outside its most
            # frequent component against the rest.
            spread = labelled.groupBy("signature").agg(F.min("c").alias("_low"), F.max("c").alias("_high"))
            spread = stored(spread.where("_low != _high").select("signature"), "spread")
            known = spread.count()
            rest = stored(semi_join(labelled, spread, "signature", known).select("signature", "node", "c").distinct(), "rest")
            main = rest.groupBy("signature", "c").agg(F.count(F.lit(1)).alias("_n"))
            main = main.groupBy("signature").agg(F.max(F.struct("_n", "c")).alias("_main"))
            main = main.select(F.col("signature").alias("_of"), F.col("_main.c").alias("_in"))
            side = F.broadcast(main) if known <= BROADCAST_ROWS else main
            outside = rest.join(side, (F.col("signature") == F.col("_of")) & (F.col("c") != F.col("_in"))).drop("_of", "_in")
            outside = stored(outside, "outside")
            left = outside.join(facts, "node").select("signature", F.col("node").alias("a"), F.col("c").alias("_c"), F.col("fact").alias("_f"))
            rest = rest.join(facts, "node")
            right = rest.select("signature", F.col("node").alias("b"), F.col("c").alias("_d"), F.col("fact").alias("_g"))
            apart = (F.col("_c") != F.col("_d")) & possible(F.col("_f"), F.col("_g"))
            crossed = left.join(right, (left["signature"] == right["signature"]) & apart)
            pairs = crossed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = stored(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionByName(pairs)
        # The stars of the components stand for the links so far.
        stars = label.where(F.col("node") != F.col("component")).select(F.col("component").alias("a"), F.col("node").alias("b"))
        links = stars.unionByName(stored(verify(pairs), "links"))
    return links
