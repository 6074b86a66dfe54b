"""Landing parsers, table layouts, incremental loads and the named-table catalog."""
