"""Training-data operators: near-duplicates, archives, mixing, secrets, counts,
decontamination, quality, URL rules and sharding, each as Spark jobs.

Nothing outside this subpackage imports it; ``registry`` holds its queries.
"""
