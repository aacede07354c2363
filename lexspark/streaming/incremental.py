"""Matching of attestations as they arrive: the batch operators applied to each micro-batch.

Matching is stateless by attestation, so nothing is kept between batches. Each batch writes a
folder of its own and overwrites it if it is run again, so results are exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lexspark.operators.match import build_keys, match_entities


def match_stream(attestations: DataFrame, concepts: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Starts a query that writes (concept_id, evidence_id, reasons) of a stream of attestations below path."""

    def one(batch: DataFrame, epoch: int) -> None:
        match_entities(concepts, build_keys(batch)).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return attestations.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
