"""Operators: each takes DataFrames (or a ``Graph`` of two) and returns DataFrames.

``reports``   filters, grouped reports, top-k rows, first rows per group
``quality``   confusion ratios, area under ROC
``sampling``  splits and stratified samples
``graph``     degrees, triplets, aggregated messages
``rank``      PageRank
``motifs``    patterns of edges
``paths``     breadth-first paths and hop counts
``learning``  the delay classifier
``skew``      measured broadcasts and hot keys, used by the others
"""
