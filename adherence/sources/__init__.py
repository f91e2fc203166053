"""Sources and sinks: header-mapped CSV, snapshot tables, file streams."""
