"""DataFrame operators: dedup, prefilter, evaluation, routing, state, cards."""
