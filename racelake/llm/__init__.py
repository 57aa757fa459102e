"""Operators for building language-model training data, one module each.

Nothing outside this package imports it. Every operator takes a DataFrame
with an id and a text column, ignores all other columns (whatever their
names), treats a NULL text as an empty one, and returns one row per input
row unless its docstring says otherwise. Repeated rows are separate
documents; an empty table gives an empty result with the same schema.
"""
