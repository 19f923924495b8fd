"""Where profiles, statuses and raw flows are written."""

from .count_store import CountStore
from .edge_store import EdgeStore
from .flow_memory import FlowMemory, representative_flows
from .scope_log import ScopeLog
from .status_log import StatusLog
from .day_files import write_day_files, start_day_files_stream, day_column
from ..sources.jdbc import write_jdbc
from .profile_export import export_profiles_jdbc

__all__ = ["CountStore", "EdgeStore", "FlowMemory", "ScopeLog", "StatusLog", "representative_flows", "write_day_files", "start_day_files_stream", "day_column", "write_jdbc",
           "export_profiles_jdbc"]
