"""DataFrame operators: model columns, histories, exact ranks and splits, aggregates."""
