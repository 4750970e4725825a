"""Landing files, the raw table, reports and table inventories."""
