"""DataFrame operators. Each takes and returns DataFrames; those that need
figures first (quantiles, fits, group sizes) say so and fetch a bounded number."""
