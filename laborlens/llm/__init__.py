"""Operations of a training-data pipeline over documents, vectors and tokens.

Nothing else in the library imports this subpackage.
"""
