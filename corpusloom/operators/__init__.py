"""Operators over DataFrames.

Clocks, clients, stores and models are parameters, never globals (X08).  Aggregates such as centroids, momentum
and leave-one-out medians are compositions of built-in ones (X09), and operators that make several rows of one are
``explode`` over array functions (X10); no Python runs for either.
"""
