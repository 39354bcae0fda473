"""Enrichment providers used by the registered queries. Kept free of Spark imports:
Python workers unpickle providers by module name and import only this module."""


def fold_provider(texts):
    """Stand-in transliteration provider: NFKD, then drop non-ASCII."""
    return texts.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")
