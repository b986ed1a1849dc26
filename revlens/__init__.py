"""revlens: review-text analytics expressed as Spark DataFrame / SQL plans.

Sub-packages
------------
functions  Column -> Column builders (cleaning primitives, profiles, n-grams, fixed word lists)
sources    readers / writers (review TSV, prediction sets, submissions, stores, driver tables)
operators  DataFrame -> DataFrame operators (corpus stats, features, embeddings, splits,
           metrics, learners, ensembles, exact distributed ranking)
plans      named query catalog (key -> Spark builder + DuckDB oracle SQL)
streaming  Structured Streaming scoring of arriving reviews
"""

__version__ = "0.1.0"
