"""Operations of a training-data pipeline: dedup, joins, classifiers, tokens, packing, sharding, search."""
