"""Operators for preparing training text, each by one named method.

Nothing else in the library imports this package. Operators take and return
DataFrames; each module also holds its thin registered query. Input columns
are picked by name at entry, so further columns, whatever their names, never
clash with the working columns.
"""
