"""Streaming.

The reference reads two complete tables and has no stream, watermark or state,
so no streaming operator is built.  The apply side of every fitted operator is
an equi-join against a small fitted table (``groups.apply_stats``), which Spark
executes unchanged as a stream-static join on a streaming DataFrame.
"""
