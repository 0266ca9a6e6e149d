"""Incremental processing: work-list files consumed as a Structured Streaming source.

The original tool has no event streams (no watermarks, windows or state);
its incrementality is "run per work-list file, skip stored keys, upsert".
``worklist_stream`` expresses exactly that with a file source and
``foreachBatch``.
"""
