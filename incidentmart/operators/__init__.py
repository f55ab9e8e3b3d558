"""DataFrame operators: joins, enrichment, keys, measures, reshaping, rules."""
