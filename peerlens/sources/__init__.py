"""Sources and sinks: file/table scans, audit columns, writes, compaction, fixtures."""
