"""Silver and gold models, ranking, exact distinct counts and data-quality checks."""
