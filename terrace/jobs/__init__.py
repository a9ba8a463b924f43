"""One job for each source: bronze tables in, silver, rejects, gold and checks out.

A job takes and returns DataFrames, so the caller decides where they are stored.
"""
