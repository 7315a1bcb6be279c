"""Training-data operators (one module each) and their registered queries.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when the folder is there.
"""
