"""The 25 jobs, each a function from input DataFrames to one output DataFrame.

Bounded and streaming inputs use the same functions; operators with state pick
their form from the input.
"""
