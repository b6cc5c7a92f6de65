"""Where records come from and the tables they land in."""

from eventlake.sources.files import raw_file_stream
from eventlake.sources.folder import Folder
from eventlake.sources.kafka import kafka_options, kafka_stream
from eventlake.sources.table import LakeTable, SchemaConflict

__all__ = [
    "Folder",
    "LakeTable",
    "SchemaConflict",
    "kafka_options",
    "kafka_stream",
    "raw_file_stream",
]
