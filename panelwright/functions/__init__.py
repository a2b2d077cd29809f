"""Column-level building blocks: null arithmetic, calendar helpers, sample statistics."""
