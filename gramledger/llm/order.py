"""Row numbers in a global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramledger.llm.text import stored

PLACE_BITS = 33  # what monotonically_increasing_id() leaves for the place within a partition


def numbered(rows: DataFrame, *order: Column, name: str) -> DataFrame:
    """rows with `name`: 1, 2, 3, ... in the given order, which should leave no ties.

    Rows are dealt out in ranges of the order and sorted within them. The driver gets one
    count per partition and sends back how many rows lie before each.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(placed.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__at", PLACE_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    before, offsets = 0, []
    for part_id, n in sorted((r.part, r.n) for r in sizes):
        offsets.append((part_id, before))
        before += n
    # A row per partition: that is the bound for sending them to all tasks.
    starts = rows.sparkSession.createDataFrame(offsets, "__part bigint, __before bigint")
    within = F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    found = placed.join(F.broadcast(starts), part == F.col("__part"))
    return found.withColumn(name, F.col("__before") + within + 1).drop("__at", "__part", "__before")
