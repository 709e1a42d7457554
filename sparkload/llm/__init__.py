"""Operations of a training-data pipeline: scans, scoring, deduplication, mixing, token output, search.

Every operator takes DataFrames and column names and returns a DataFrame. Conventions that hold in
all of them unless a docstring says otherwise: a null text is an empty text; rows without an id take
no part in matching; columns other than the named ones are ignored, whatever they are called; an
empty table gives an empty result of the same schema.
"""
