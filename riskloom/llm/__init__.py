"""Training-data pipeline operators (language ID, decontamination, dedup, mixing, sharding, …).

Nothing else in the library imports this subpackage; ``__spark_entry__`` registers its
queries only when it is present.
"""
