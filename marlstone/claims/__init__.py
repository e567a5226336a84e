"""Claims pack: contracts, rules, generator, warehouse models and metrics, composed from the generic operators."""
