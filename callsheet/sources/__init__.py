"""Sources and sinks: star-table contacts, delimited files, typed coercion, tables."""
