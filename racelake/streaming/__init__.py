"""Structured Streaming jobs: incremental CSV ingest (bronze), incremental
cleaning (silver) and the append-only fact stream (gold).

All three are stateless appends: every run processes the files / rows that
arrived since the last checkpoint (``trigger(availableNow=True)``) and
stops. No watermark or state store is needed because nothing is
aggregated across micro-batches.
"""

from racelake.streaming.ingest import ingest_csv_checked, ingest_csv_stream, ingest_landing_root
from racelake.streaming.fact import stream_fact_results
from racelake.streaming.silver import silver_results, stream_cleaned_results

__all__ = ["ingest_csv_checked", "ingest_csv_stream", "ingest_landing_root", "stream_fact_results",
           "silver_results", "stream_cleaned_results"]
