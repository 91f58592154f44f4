"""Incremental scans of arriving delimited files.

The workloads have no stream processing of their own.  This package only
lets the existing scan / count / group-count operators run on files as they
land in a folder (Structured Streaming file source, explicit schema), with
the stream's checkpoint in the shared folder.
"""

from clinlake.streaming.files import read_delimited_stream, run_available

__all__ = ["read_delimited_stream", "run_available"]
