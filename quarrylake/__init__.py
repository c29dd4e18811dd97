"""quarrylake: data processing on Spark DataFrames, from raw exports to a checked star schema."""
