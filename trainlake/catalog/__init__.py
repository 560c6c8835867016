"""Registered queries, each with the SQL that must give the same rows.

A module holds QUERIES (name to function of session and folder) and ORACLES
(name to SQL). The first words of a query's docstring are the ids of the
"""
