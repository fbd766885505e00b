"""Score organisations by what they disclose and by how the news reports on them.

Everything is a function from DataFrame to DataFrame (or from Column to
Column).  ``functions`` holds column expressions, ``operators`` holds relational
steps, ``sources`` reads and writes, ``streaming`` ingests files as a drained
stream and ``plans`` strings the steps together into whole pipelines.
"""
