"""DataFrame operators: features, models, retrieval, evaluation."""
