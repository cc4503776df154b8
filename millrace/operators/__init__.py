"""DataFrame operators of the enrichment job."""
