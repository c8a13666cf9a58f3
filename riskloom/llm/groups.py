"""Rows of sorted partitions, one key at a time, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import stored


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal keys from batches that are sorted by them."""
    held: list[pa.Table] = []
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if not t.num_rows:
            continue
        if held:
            last = held[-1]
            if any(t.column(k)[0].as_py() != last.column(k)[last.num_rows - 1].as_py() for k in keys):
                yield pa.concat_tables(held).combine_chunks()
                held = []
        cut = np.zeros(t.num_rows, bool)
        for k in keys:
            c = t.column(k).combine_chunks()
            cut[1:] |= np.asarray(pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)))
        at = 0
        for stop in np.flatnonzero(cut):
            held.append(t.slice(at, stop - at))
            yield pa.concat_tables(held).combine_chunks()
            held, at = [], stop
        held.append(t.slice(at))
    if held:
        yield pa.concat_tables(held).combine_chunks()


def components(edges: DataFrame) -> DataFrame:
    """The smallest id that each id of ``edges`` (u, v) is connected to: id, root.

    Each round takes the smallest label among the neighbours and then that label's own
    label, so paths shorten to half and the rounds grow with the logarithm of the longest
    one. Every round is a written table; nothing but a count reaches the driver.
    """
    both = edges.where("u <> v")
    both = both.select("u", "v").unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    both = stored(both, "edges")
    labels = stored(both.groupBy(F.col("u").alias("id")).agg(F.least(F.first("u"), F.min("v")).alias("root")), "labels")
    while True:
        near = both.join(labels, both["v"] == labels["id"]).select(F.col("u").alias("id"), "root")
        least = near.unionByName(labels).groupBy("id").agg(F.min("root").alias("root"))
        least = stored(least, "labels")
        up = least.select(F.col("id").alias("_up"), F.col("root").alias("_root"))
        jumped = least.join(up, least["root"] == up["_up"], "left").select("id", F.least("root", F.coalesce("_root", "root")).alias("root"))
        jumped = stored(jumped, "labels")
        old = labels.select(F.col("id").alias("_id"), F.col("root").alias("_old"))
        if jumped.join(old, (jumped["id"] == old["_id"]) & (jumped["root"] == old["_old"]), "left_anti").isEmpty():
            return jumped
        labels = jumped
