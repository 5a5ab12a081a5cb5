"""Training-data pipeline operators (dedup, tokenization, mixing, search, quality).

Nothing outside this folder imports it; ``panelcast.llm.registry`` holds the
queries that ``__spark_entry__`` adds.
"""
