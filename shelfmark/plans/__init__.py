"""Multi-operator jobs: feature build, evaluation, grid search, diagnostics."""
