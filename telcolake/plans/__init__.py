"""The jobs: cleaning, star schema, features, model, measures and data checks."""
