"""Column-level building blocks: patterns, text normalisation, identifiers, rule chains."""
