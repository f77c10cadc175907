"""Retail listing-panel analytics on Spark DataFrames.

``functions``  column expressions (text, numbers, dates, states, addresses)
``operators``  DataFrame building blocks (keys, de-dup, positions, changes, checks)
``sources``    readers, the marketplace dimension and sinks
``plans``      the user-level jobs put together from the above
"""
