"""DataFrame -> DataFrame operators: pivots, series, box match, terms, lookups."""
