"""DataFrame operators: profiling, scaling, encoding, outliers, windows,
splits, models, evaluation, tuning and compression."""
