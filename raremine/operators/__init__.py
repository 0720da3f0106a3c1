"""DataFrame -> DataFrame operators (cleaning, features, statistics, sampling,
text, models, metrics)."""
