"""Incremental ingest: each new document is parsed exactly once and appended."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from articlelake.operators.tei import extract_articles


def ingest_stream(
    files: DataFrame, table: str, checkpoint: str, path: str = "path", content: str = "content",
    fields: Sequence[str] | None = None, carry: Sequence[str] = (),
) -> None:
    """Parse what arrived in the stream ``files`` since the last run and append it to ``table``.

    The run ends when the backlog is done.  Which files were read is kept in
    ``checkpoint``, and the file sink commits each batch as a whole, so a run
    that was cut short neither loses nor repeats documents.  ``table`` holds
    every document with its status: see ``good_articles`` and ``quarantine``.
    A file that changes later keeps its path and is not read again: read the
    changed paths of ``snapshot_diff`` with ``read_files`` in a batch run, into
    a table of their own, since readers of ``table`` see only what the stream
    committed; join the two when reading.
    """
    parsed = extract_articles(files, path, content, fields, carry)
    query = (
        parsed.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
