"""Sources: declared schemas, JSON-lines files, JDBC, document store, and the source switch."""

from .files import read_json_lines, read_layer, write_layer
from .jdbc import JdbcSpec, read_jdbc, tls_url, write_jdbc
from .switch import SourceSpec, load_source, load_views

__all__ = [
    "JdbcSpec",
    "SourceSpec",
    "load_source",
    "load_views",
    "read_json_lines",
    "read_jdbc",
    "read_layer",
    "tls_url",
    "write_jdbc",
    "write_layer",
]
