"""DataFrame-to-DataFrame operators: filters, keep-latest, unnest, state, metrics, margins."""
