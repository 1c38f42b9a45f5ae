"""The usage ledger as a stream: signed events are added up as they come, and the sums that change are written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabweave.constants import KEY_SEPARATOR, NULL_MARK
from tabweave.operators.ledger import file_usage, usage_events
from tabweave.plans.store import Store

LEDGER = "ledger"


def run_ledger(
    changes: DataFrame, store: Store, name: str, checkpoint: str, by: Sequence[str] = ("file", "request")
) -> StreamingQuery:
    """Bring the ledger ``name`` up to date with the request changes that are there, then stop.

    The sums are the state of the stream; each batch gives the groups that it changed with their new sums, which
    replace the former ones in the ledger's table. A batch that is given again gives the same rows, so a restart
    counts nothing twice. Written and merged are the changed groups only, not the ledger.
    """
    usage = file_usage(usage_events(changes), by)
    key = F.concat_ws(KEY_SEPARATOR, *[F.coalesce(F.col(b).cast("string"), F.lit(NULL_MARK)) for b in by])

    def batch(sums: DataFrame, _: int) -> None:
        store.change(LEDGER, name, sums.select(key.alias("src_key"), *by, "uses"))

    return (
        usage.writeStream.outputMode("update")
        .foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ledger(store: Store, name: str) -> DataFrame | None:
    """The ledger as it is now: a row for each group with its ``uses``; None before the first batch."""
    rows = store.read(LEDGER, name)
    return None if rows is None else rows.drop("src_key")
