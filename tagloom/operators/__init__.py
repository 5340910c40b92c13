"""DataFrame operators: joins, aggregates and windows over grids, posts and pages."""
