"""DataFrame operators: order tables, features, binning, sampling,
skew-safe running sums, evaluation and EDA reports."""
