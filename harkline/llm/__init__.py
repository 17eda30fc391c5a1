"""Operations for the preparation of training data.

Nothing else in the package imports from here.
"""
