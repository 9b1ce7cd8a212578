"""DataFrame -> DataFrame operators: joins, keys, numbering, sets, changes, quality."""
