"""Streams of requests: a stream-static join where keys suffice, micro-batches of the batch plan elsewhere."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lookfuse.operators.skew import fits_broadcast
from lookfuse.plans.enrich import build, needs_micro_batches
from lookfuse.plans.options import Options
from lookfuse.session import scratch_folder
from lookfuse.sources.requests import Flush
from lookfuse.streaming.sink import FolderSink

CONSOLE = "console"
BATCH_KEYS = 1000  # the largest batch the request side sends in one go

Lookup = DataFrame | Callable[[], DataFrame]
Sink = str | Callable[[DataFrame, int], None]


def enrich_stream(
    requests: DataFrame,
    lookup: Lookup,
    *,
    sink: Sink,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    flush: Flush | None = None,
    join_sink: bool = False,
    **options,
) -> StreamingQuery:
    """Start enriching a stream. Options are those of :func:`lookfuse.enrich`.

    ``sink`` is a folder (read it back with :func:`read_sink`), ``"console"``, or a function of (batch DataFrame, batch
    id), which may see a batch again after a failure. Every batch of a folder is committed once: the checkpoint lies in the
    folder unless stated, so the same call goes on where the last one stopped, and a folder that another checkpoint has
    written to is refused, or with ``join_sink`` added to. ``flush`` says when a batch goes out: after so many
    seconds, or with so many files or bytes if the source was opened with it (:func:`requests_from_files`); ``trigger`` takes
    the arguments of ``DataStreamWriter.trigger`` instead. ``lookup`` as a function is called for each batch, so changes of the table are
    seen; as a DataFrame it is planned once. The lookup must not be a stream.

    Each micro-batch runs the batch plan and writes a folder of its own. Unless the lookup can be broadcast, a batch's
    keys, if there are at most ``pushdown_keys`` (1000) of them, go to the lookup's source as a filter: lay a large
    lookup out by key. To the console, a small lookup matched on keys is joined as a static side.
    """
    if not requests.isStreaming:
        raise ValueError("`requests` is not a stream; use enrich()")
    chosen = Options(**{"pushdown_keys": BATCH_KEYS, **options})
    spark = requests.sparkSession
    sample = lookup() if callable(lookup) else lookup
    by_batch = callable(lookup) or callable(sink) or not fits_broadcast(sample)
    by_batch = by_batch or needs_micro_batches(requests, sample, chosen)
    if flush is not None and trigger is not None:
        raise ValueError("Give `flush` or `trigger`, not both")
    trigger = trigger or (flush or Flush()).trigger()
    to_folder = isinstance(sink, str) and sink != CONSOLE
    checkpoint = checkpoint or (f"{sink.rstrip('/')}/checkpoint" if to_folder else scratch_folder(spark, "stream-checkpoint"))

    if not by_batch and sink == CONSOLE:
        writer = build(requests, sample, chosen).writeStream.outputMode("append").format("console")
    else:
        # A folder is laid out the same for every plan, so a lookup may outgrow broadcasting between two runs.
        chosen = chosen if by_batch else replace(chosen, pushdown_keys=options.get("pushdown_keys", 0))
        folder = FolderSink(spark, sink, checkpoint, join_sink) if to_folder else None

        def run(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()
            batch.count()  # planning looks at the size and the keys before the result does
            try:
                enriched = build(batch, lookup() if callable(lookup) else lookup, chosen)
                if callable(sink):
                    sink(enriched, batch_id)
                elif sink == CONSOLE:
                    enriched.show()
                else:
                    folder.write(enriched, batch_id)
            finally:
                batch.unpersist()

        writer = requests.writeStream.foreachBatch(run)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
