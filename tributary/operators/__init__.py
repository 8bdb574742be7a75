"""DataFrame -> DataFrame operators: columns, metadata, quality, checks,
union, retention."""
