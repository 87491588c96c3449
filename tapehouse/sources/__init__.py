"""Sources and sinks: feed streams, table DDL and writes, keyed publishing."""
