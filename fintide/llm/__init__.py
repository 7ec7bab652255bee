"""Training-data pipeline operators (corpus filtering, deduplication, mixing, packing, search).

Nothing outside this folder imports it.  Every operator takes and returns
DataFrames; ``queries`` registers one production query per operator.
"""
