"""Operations of a training-data pipeline on documents and pages; nothing else in the library imports this package."""
