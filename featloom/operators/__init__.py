"""DataFrame operators: cleaning, rollups, encoders, ranks, selection, models, metrics."""
