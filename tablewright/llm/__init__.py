"""Training-data operators: mixing, tokenizing, de-duplication, filters, classifiers.

One module per operator; ``queries.py`` registers the queries and their SQL.
Nothing else in the library imports this subpackage.
"""
