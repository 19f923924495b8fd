"""H1-H8: the Structured Streaming profile job."""

from .profile_stream import (ProfileStream, start_profile_stream, run_profile_stream_on_files, edge_stream,
                             start_edge_file_stream)

__all__ = ["ProfileStream", "start_profile_stream", "run_profile_stream_on_files", "edge_stream",
           "start_edge_file_stream"]
