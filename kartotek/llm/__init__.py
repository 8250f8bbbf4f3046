"""Operations of a training-data pipeline: search, counting, filters, duplicates, mixing, formats."""
