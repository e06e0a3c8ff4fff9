"""DataFrame operators: joins, feature derivation, model, reports, run history."""
