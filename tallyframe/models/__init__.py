"""The operators on ready-made data models: players, games, actors, web traffic, matches.

Each function takes DataFrames with the columns of its model and returns a DataFrame, so a job
is a read, one of these calls and a write from ``tallyframe.sources``.
"""
